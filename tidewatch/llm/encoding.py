"""Token ids of whole texts, with each distinct piece of text encoded once per worker.

Byte-level BPE works on pieces that its splitting pattern cuts from the text, each on its own. So the
pieces are found for a block of texts at once with numpy, looked up by hash, and only those not
seen before go through the tokenizers library. Added tokens are cut from the text before that, as the
library does it; special ones only where asked for. A vocabulary with any other set-up is used directly.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np

from tidewatch.llm.arrays import hash_runs, spans

LETTER, NUMBER, OTHER, SPACE, END = range(5)
#: White space as Unicode's property has it (fixed values).
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe as a piece of its own (fixed values).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
CUT = re.compile(r"(?<=[a-z]) (?=[a-z])")
LONG_PIECE = 255

_classes: np.ndarray | None = None
_encoders: dict[tuple[str, int, bool], Encoder] = {}


def _class_table() -> np.ndarray:
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.array(
            [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8
        )
        table[SPACES] = SPACE
        _classes = table
    return _classes


def encoder(path: str, slots: int = 1 << 21, special_tokens: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file, made once."""
    key = path, slots, special_tokens
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def _segments(text: str, size: int) -> list[str]:
    """Cut a very long text where a piece begins in any case: at a space between two letters."""
    out, begin = [], 0
    while len(text) - begin > 2 * size:
        found = CUT.search(text, begin + size)
        if not found:
            break
        out.append(text[begin : found.start()])
        begin = found.start()
    return [*out, text[begin:]]


class Encoder:
    """Encodes texts. With ``special_tokens`` a special token's string in a text gives that token's
    id, which is the library's default; without, it is ordinary text.
    """

    def __init__(self, path: str, slots: int, special_tokens: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        self.vocabulary = self.tokenizer.get_vocab_size()
        setup = json.loads(self.tokenizer.to_str())
        split = setup["pre_tokenizer"] or {}
        added = [t for t in setup["added_tokens"] if special_tokens or not t["special"]]
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut_added = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
        self.by_pieces = (
            setup["model"]["type"] == "BPE" and setup["normalizer"] is None
            and not setup["model"].get("dropout") and split.get("type") == "ByteLevel"
            and split.get("use_regex") and not split.get("add_prefix_space")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
            and len({t["normalized"] for t in added}) <= 1
        )
        self._clear(slots)

    def _clear(self, slots: int) -> None:
        self.slots, self.shift = slots, np.uint64(64 - (slots.bit_length() - 1))
        self.keys = np.zeros(self.slots, np.uint64)
        self.begin = np.zeros(self.slots, np.int32)
        self.length = np.zeros(self.slots, np.int32)
        self.pool, self.filled, self.known = np.zeros(1 << 16, np.uint32), 0, 0

    def encode(self, texts: list[str], block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each text has."""
        counts = np.zeros(len(texts), np.int64)
        parts, held, owners, marks, size = [], [], [], {}, 0
        for row, text in enumerate(texts):
            for segment in self._parts(text, block):
                if isinstance(segment, int):
                    marks[len(held)], segment = segment, ""
                held.append(segment)
                owners.append(row)
                size += len(segment) + 1
                if size >= block:
                    parts.append(self._block(held, owners, marks, counts))
                    held, owners, marks, size = [], [], {}, 0
        if held:
            parts.append(self._block(held, owners, marks, counts))
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), counts

    def _parts(self, text: str, size: int) -> list[str | int]:
        """The parts of a text that are encoded on their own, added tokens as their ids."""
        if not self.by_pieces:
            return [text]
        if not any(token in text for token in self.added):
            return _segments(text, size)
        out: list[str | int] = []
        for k, part in enumerate(self.cut_added.split(text)):
            out += [self.added[part]] if k % 2 else _segments(part, size)
        return out

    def _block(
        self, texts: list[str], owners: list[int], marks: dict[int, int], counts: np.ndarray
    ) -> np.ndarray:
        """Ids of the texts; in place of those that ``marks`` numbers stands the id that it gives."""
        if not self.by_pieces:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            lists = [np.array(x.ids, np.uint32) for x in found]
            np.add.at(counts, owners, [len(x) for x in lists])
            return np.concatenate(lists)
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        begins, ends = self._pieces(points, stops)
        hashes = hash_runs(points, begins, ends)
        hashes[hashes == 0] = 1
        slots = self._find(hashes)
        long = ends - begins > LONG_PIECE
        new = (slots < 0) & ~long
        if new.any():
            if self.known + len(np.unique(hashes[new])) > self.slots // 2:
                # start anew with all pieces of this block, in a larger table if they need it
                new = ~long
                self._clear(max(self.slots, 1 << (4 * len(np.unique(hashes[new]))).bit_length()))
            self._learn(joined, begins[new], ends[new], hashes[new])
            slots[new] = self._find(hashes[new])
        sizes = np.where(long, 0, self.length[slots])
        firsts = self.begin[slots].astype(np.int64)
        pool = self.pool
        if long.any():  # very long pieces are never looked up by hash
            places = np.flatnonzero(long)
            found = [self._ids(joined[begins[i] : ends[i]]) for i in places]
            pool = np.concatenate([self.pool[: self.filled], *found])
            sizes[places] = [len(x) for x in found]
            firsts[places] = self.filled + np.cumsum(sizes[places]) - sizes[places]
        of = np.searchsorted(stops, begins)
        per_text = np.bincount(of, sizes, len(texts)).astype(np.int64)
        ids = pool[spans(firsts, sizes)]
        if marks:
            places = list(marks)
            ids = np.insert(ids, np.cumsum(per_text)[places], list(marks.values()))
            per_text[places] += 1
        np.add.at(counts, owners, per_text)
        return ids

    def _pieces(self, points: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _class_table()[points]
        kind[stops] = END
        before = np.empty_like(kind)
        before[0], before[1:] = END, kind[:-1]
        after = np.empty_like(kind)
        after[-1], after[:-1] = END, kind[1:]
        begin = kind != before
        space = kind == SPACE
        # the last white space before a word stands alone, or joins the word if it is a plain space
        last = space & (after < SPACE)
        begin |= last
        joins = last & (points == 0x20)
        begin[1:] &= ~joins[:-1]
        quotes = np.flatnonzero((points == 0x27) & (before != OTHER) & (after == LETTER))
        if len(quotes):
            quotes = quotes[(quotes == 0) | (points[quotes - 1] != 0x20) | (before[quotes] == END)]
            near = [points[np.minimum(quotes + k, len(points) - 1)] for k in (1, 2)]
            for word in CONTRACTIONS:
                fits = near[0] == ord(word[0])
                if len(word) == 2:
                    fits &= near[1] == ord(word[1])
                at = quotes[fits]
                begin[at + 1] = False
                rest = at + 1 + len(word)
                begin[rest[kind[rest] == LETTER]] = True
        begins = np.flatnonzero(begin)
        ends = np.append(begins[1:], len(points))
        real = kind[begins] != END
        return begins[real], ends[real]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 if it isn't known."""
        slots = (hashes >> self.shift).astype(np.int64)
        keys = self.keys[slots]
        open_ = np.flatnonzero(keys != hashes)
        while len(open_):
            empty = self.keys[slots[open_]] == 0
            slots[open_[empty]] = -1
            open_ = open_[~empty]
            slots[open_] = (slots[open_] + 1) % self.slots
            open_ = open_[self.keys[slots[open_]] != hashes[open_]]
        return slots

    def _ids(self, piece: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, np.uint32)

    def _learn(self, joined: str, begins, ends, hashes) -> None:
        hashes, first = np.unique(hashes, return_index=True)
        pieces = [joined[b:e] for b, e in zip(begins[first], ends[first], strict=True)]
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        lists = [x.ids for x in found]
        sizes = np.array([len(x) for x in lists])
        flat = np.array([i for x in lists for i in x], np.uint32)
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.filled : self.filled + len(flat)] = flat
        starts = self.filled + np.cumsum(sizes) - sizes
        self.filled += len(flat)
        self.known += len(hashes)
        keys, slots = self.keys, (hashes >> self.shift).tolist()
        for slot, key, start, size in zip(slots, hashes, starts, sizes, strict=True):
            while keys[slot]:
                slot = (slot + 1) % self.slots
            keys[slot], self.begin[slot], self.length[slot] = key, start, size

"""Benchmark decontamination: passages within a bounded edit distance of an item.

A document is contaminated by an item if some run of its words, of any length, lies within ``share``
of the item's words in edit distance (words in lower case, punctuation apart). Candidates are
item-sized windows, also those that the document's end cuts off; each is verified against the best
run of words in and around it. They come from a
CGK embedding: a random walk over a sequence that stays or steps on at each position by a random bit
of the current word, so that near sequences stay in step and edit distance becomes Hamming distance.
Repeated bit sampling of the embedded positions, over several independent walks, puts near pairs
into a common bucket with the target recall; each candidate is then verified by its exact distance.

Before embedding, windows are dropped that can't qualify: each edit destroys at most three of an
item's three-word runs, so a passage must keep a certain number of runs that occur in the benchmark,
within the item's length and the most insertions. That bound loses nothing. The work is one pass over the documents without a shuffle; the benchmark
is taken in blocks of bounded size, each of which is broadcast.

Nulls and edge cases: null and empty texts hold nothing; items of fewer than ``LEAST_WORDS`` words
(and null ones) are too short to tell and match nothing; those of more than ``LONGEST_ITEM`` words
are cut into items of that length; repeated rows and items are each reported;
an empty table or benchmark gives no rows. Further columns are ignored by ``contaminated`` and kept
by ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrays import as_strings, buffers, chain, hash_runs, mix, row_blocks, spans, words

HITS = "doc_id long, item_id long, edits int, n_words int, begin long, end long"
LEAST_WORDS = 6
RUN = 3
#: Independent walks, samples of each, and sampled positions per sample: recall above 0.99 at the bound.
WALKS, SAMPLES, POSITIONS = 16, 4, 2
#: Items that are broadcast together.
BLOCK = 20_000
LONGEST_ITEM = 4096

#: A-Z in lower case; ASCII that is no letter or digit as a space.
PLAIN = np.full(256, 0x20, np.uint8)
PLAIN[0x80:] = np.arange(0x80, 0x100)
for _c in range(0x80):
    if chr(_c).isalnum():
        PLAIN[_c] = ord(chr(_c).lower())


def most_edits(n_words: int, share: float) -> int:
    return int(n_words * share + 1e-9)


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Hashes of the words of each row, their places in the bytes, and each row's first word."""
    plain = PLAIN[data]
    begins, ends, first = words(plain, offsets)
    return hash_runs(plain, begins, ends), begins, ends, first


def embed(x: np.ndarray, lengths: np.ndarray, walks: np.ndarray) -> np.ndarray:
    """CGK embeddings of sequences (rows of ``x``, filled up with 0): positions, rows, walks.

    A walk of three times the length would cover any sequence; at two, half of them are through,
    and the rest of the positions would mostly hold the filler 0.
    """
    rows, n_walks, steps = len(x), len(walks), 2 * x.shape[1]
    at = np.zeros((rows, n_walks), np.int64)
    out = np.zeros((steps, rows, n_walks), np.uint64)
    every, ends = np.arange(rows)[:, None], lengths[:, None]
    for j in range(steps):
        symbol = np.where(at < ends, x[every, np.minimum(at, ends - 1)], np.uint64(0))
        out[j] = symbol
        at += (mix(symbol ^ walks[:, j]) & np.uint64(1)).astype(np.int64)
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Edit distances between rows of two arrays of word hashes."""
    rows, length = x.shape
    places = np.arange(y.shape[1] + 1)
    last = np.broadcast_to(places, (rows, len(places))).copy()
    for i in range(length):
        now = np.empty_like(last)
        now[:, 0] = i + 1
        now[:, 1:] = np.minimum(last[:, 1:] + 1, last[:, :-1] + (x[:, i : i + 1] != y))
        # a step along the row costs one: a running minimum of value less place
        last = np.minimum.accumulate(now - places, axis=1) + places
    return last[:, -1]


def best_runs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edits, begin and end (columns of ``y``) of the run in each row of ``y`` that is nearest to ``x``'s row.

    The run may begin and end anywhere; among equals the shortest of those that end first.
    """
    rows, width = y.shape
    unit = width + 1  # a value is edits * unit + (width - begin)
    places = np.arange(width + 1)
    last = np.broadcast_to(width - places, (rows, width + 1)).copy()
    for i in range(x.shape[1]):
        now = last + unit
        now[:, 1:] = np.minimum(now[:, 1:], last[:, :-1] + unit * (x[:, i : i + 1] != y))
        last = np.minimum.accumulate(now - places * unit, axis=1) + places * unit
    # the fewest edits first, then the shortest run
    edits = last // unit
    length = np.maximum(places - (width - last % unit), 0)
    end = np.argmin(edits * (unit + 1) + length, axis=1)
    every = np.arange(rows)
    return edits[every, end], width - last[every, end] % unit, end


class Index:
    """A block of items: their three-word runs, and the buckets of their embeddings."""

    def __init__(self, items: list[tuple[int | None, str | None]], share: float, seed: int = 17) -> None:
        self.share, self.seed = share, seed
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        hashes, _, _, first = word_hashes(*buffers(texts))
        held = [
            (item_id, hashes[k : min(b, k + LONGEST_ITEM)])
            for (item_id, _), a, b in zip(items, first[:-1], first[1:], strict=True)
            for k in range(a, b, LONGEST_ITEM)
            if min(b, k + LONGEST_ITEM) - k >= LEAST_WORDS
        ]
        self.ids = [item_id for item_id, _ in held]
        self.lengths = np.array([len(h) for _, h in held], np.int64)
        self.longest = int(self.lengths.max(initial=0))
        self.items = np.zeros((len(held), self.longest), np.uint64)
        for row, (_, h) in zip(self.items, held, strict=True):
            row[: len(h)] = h
        runs = [np.unique(chain(h, RUN)) for _, h in held]
        run = np.concatenate([np.zeros(0, np.uint64), *runs])
        length = np.repeat(self.lengths, [len(r) for r in runs])
        #: The runs that items have, and for each the lengths of items that have it.
        self.runs, place = np.unique(run, return_inverse=True)
        pairs = np.unique(place * (LONGEST_ITEM + 1) + length)
        self.run_lengths = pairs % (LONGEST_ITEM + 1)
        self.run_from = np.searchsorted(pairs, np.arange(len(self.runs) + 1) * (LONGEST_ITEM + 1))
        #: Runs of the item that a passage must at least have, by the item's length. Where the bound on
        #: edits leaves none for certain (shares of 0.3 and more), one is asked for all the same.
        self.least = {
            m: max(1, m - RUN + 1 - RUN * most_edits(m, share)) for m in np.unique(self.lengths).tolist()
        }

    def __getstate__(self):  # the tables are made where they are used
        return {k: v for k, v in self.__dict__.items() if k not in ("tables", "bitmap")}

    @cached_property
    def bitmap(self) -> np.ndarray:
        bits = np.zeros(1 << 20, bool)
        bits[(self.runs & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        return bits

    def known_runs(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of the benchmark are, and which."""
        at = np.flatnonzero(self.bitmap[(runs & np.uint64((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.runs, runs[at]), len(self.runs) - 1)
        same = self.runs[place] == runs[at]
        return at[same], place[same]

    def buckets(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The bucket of each row in every table (rows, tables)."""
        random = np.random.default_rng(self.seed)
        walks = random.integers(0, 1 << 63, (WALKS, 2 * LONGEST_ITEM), np.uint64)[:, : 2 * x.shape[1]]
        shares = random.random((WALKS, SAMPLES, POSITIONS))
        embedded = embed(x, lengths, walks)
        keys = np.empty((len(x), WALKS * SAMPLES), np.uint64)
        rows = np.arange(len(x))
        for w in range(WALKS):
            for s in range(SAMPLES):
                table = w * SAMPLES + s
                key = mix(lengths.astype(np.uint64) * np.uint64(WALKS * SAMPLES) + np.uint64(table))
                for share in shares[w, s]:
                    key = mix(key + embedded[(share * 2 * lengths).astype(np.int64), rows, w])
                keys[:, table] = key
        return keys

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all items in all tables, sorted, and whose they are."""
        step = max(1, 4_000_000 // (WALKS * 2 * max(1, self.longest)))
        keys = np.concatenate([
            self.buckets(self.items[k : k + step], self.lengths[k : k + step])
            for k in range(0, len(self.items), step)
        ])
        item = np.repeat(np.arange(len(keys)), keys.shape[1])
        order = np.argsort(keys.reshape(-1))
        return keys.reshape(-1)[order], item[order]

    def windows(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the windows that share enough runs with the items of their length."""
        none = np.zeros(0, np.int64)
        if not len(self.runs) or len(hashes) < RUN:
            return none, none
        at, run = self.known_runs(chain(hashes, RUN))
        count = self.run_from[run + 1] - self.run_from[run]
        at, length = np.repeat(at, count), self.run_lengths[spans(self.run_from[run], count)]
        order = np.argsort(length, kind="stable")
        at, length = at[order], length[order]
        starts, lengths = [none], [none]
        for m, least in self.least.items():
            here = at[np.searchsorted(length, m) : np.searchsorted(length, m, "right")]
            if len(here) < least:
                continue
            # each group of ``least`` neighbours allows the starts from which a passage spans it
            edits = most_edits(m, self.share)
            low, high = np.maximum(here[least - 1 :] - (m + edits - RUN), 0), here[: len(here) - least + 1]
            good = low <= high
            start = np.unique(spans(low[good], (high - low + 1)[good]))
            row = np.searchsorted(first, start, "right") - 1
            start = start[start + m - edits <= first[row + 1]]
            starts.append(start)
            lengths.append(np.full(len(start), m))
        return np.concatenate(starts), np.concatenate(lengths)

    def matches(self, x: np.ndarray, lengths: np.ndarray, around: np.ndarray, lead: np.ndarray):
        """(window, item, edits, begin, end) of the passages within reach of an item.

        ``around`` has each window with the words of its document beside it, and ``lead`` how many of
        them stand before it; begin and end are counted from the window's first word.
        """
        table, of = self.tables
        keys = self.buckets(x, lengths)
        low = np.searchsorted(table, keys.reshape(-1))
        high = np.searchsorted(table, keys.reshape(-1), "right")
        window = np.repeat(np.arange(len(x)), keys.shape[1])
        pairs, hit, shift = [np.zeros(0, np.int64)], np.flatnonzero(high > low), 0
        while len(hit):
            pairs.append(window[hit] * len(self.items) + of[low[hit] + shift])
            shift += 1
            hit = hit[low[hit] + shift < high[hit]]
        window, item = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.items)))
        good = lengths[window] == self.lengths[item]
        window, item = window[good], item[good]
        edits, begin, end = (np.zeros(len(window), np.int64) for _ in range(3))
        for m in np.unique(lengths[window]).tolist():
            rows = np.flatnonzero(lengths[window] == m)
            width = m + 2 * most_edits(m, self.share)
            step = max(1, 2_000_000 // width)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                edits[part], begin[part], end[part] = best_runs(
                    self.items[item[part], :m], around[window[part], :width]
                )
        begin, end = begin - lead[window], end - lead[window]
        limits = np.array([most_edits(m, self.share) for m in range(self.longest + 1)], np.int64)
        near = edits <= limits[lengths[window]]
        return window[near], item[near], edits[near], begin[near], end[near]


def _blocks(benchmark: DataFrame, share: float, block: int) -> Iterator[Index]:
    """Indexes of the benchmark's items, of about ``block`` items each."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    parts = max(1, -(-items.count() // block))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield Index([tuple(r) for r in items.where(part == k).collect()], share)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.2, block: int = BLOCK
) -> DataFrame:
    """The best passage for each document and item it holds (``HITS``; begin, end: code points).

    ``n_words`` is the item's; the passage may have up to ``edits`` more or fewer.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    def searched(index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _hits(batch.column("text"), index.value)
                if rows:
                    ids = batch.column("doc_id")
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": ids.take(pa.array([r[0] for r in rows])),
                        "item_id": pa.array([r[1] for r in rows], pa.int64()),
                        "edits": pa.array([r[2] for r in rows], pa.int32()),
                        "n_words": pa.array([r[3] for r in rows], pa.int32()),
                        "begin": pa.array([r[4] for r in rows], pa.int64()),
                        "end": pa.array([r[5] for r in rows], pa.int64()),
                    })

        return texts.mapInArrow(run, HITS)

    out = None
    for index in _blocks(benchmark, share, block):
        found = searched(docs.sparkSession.sparkContext.broadcast(index))
        out = found if out is None else out.unionByName(found)
    return out


def _hits(column: pa.Array, index: Index, at_once: int = 4_000_000) -> list[tuple]:
    """(row, item id, edits, words, begin, end) of the best passage for each row and item it holds."""
    if not len(index.items):
        return []
    texts = as_strings(column)
    best: dict[tuple[int, int], tuple] = {}
    held, size = [], 0

    def settle(begins, ends, points, offsets, above: int) -> None:
        x, around = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        starts, lengths, rows, lead = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4, 5))
        step = max(1, at_once // (WALKS * 2 * index.longest))
        for k in range(0, len(x), step):
            part = slice(k, k + step)
            window, item, edits, low, high = index.matches(x[part], lengths[part], around[part], lead[part])
            window = window + k
            origin = points[offsets[rows[window]]]
            from_ = points[begins[starts[window] + low]] - origin
            to = points[ends[starts[window] + high - 1]] - origin
            found = zip(rows[window].tolist(), item.tolist(), edits.tolist(), from_.tolist(), to.tolist(), strict=True)
            for row, i, *value in found:
                key, value = (above + row, i), tuple(value)
                if key not in best or value < best[key]:
                    best[key] = value

    slack = most_edits(index.longest, index.share)
    for begin, end in row_blocks(texts):
        data, offsets = buffers(texts.slice(begin, end - begin))
        hashes, begins, ends, first = word_hashes(data, offsets)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts, lengths = index.windows(hashes, first)
        step = at_once // index.longest + 1
        for k in range(0, len(starts), step):
            at, m = starts[k : k + step], lengths[k : k + step]
            row = np.searchsorted(first, at, "right") - 1
            stop = first[row + 1]
            place = at[:, None] + np.arange(index.longest)
            inside = place < np.minimum(at + m, stop)[:, None]
            x = np.where(inside, hashes[np.minimum(place, len(hashes) - 1)], 0)
            # the words beside a window, as far as the document and the most edits go
            edits = np.array([most_edits(n, index.share) for n in range(index.longest + 1)])[m]
            before = np.maximum(at - edits, first[row])
            place = before[:, None] + np.arange(index.longest + 2 * slack)
            inside = place < np.minimum(at + m + edits, stop)[:, None]
            around = np.where(inside, hashes[np.minimum(place, len(hashes) - 1)], 0)
            held.append((x.astype(np.uint64), around.astype(np.uint64), at, m, row, at - before))
            size += x.size
            if size > at_once:
                settle(begins, ends, points, offsets, begin)
                held, size = [], 0
        if held:
            settle(begins, ends, points, offsets, begin)
            held, size = [], 0
    return [
        (row, index.ids[item], edits, int(index.lengths[item]), begin, end)
        for (row, item), (edits, begin, end) in sorted(best.items())
    ]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.2, block: int = BLOCK
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; no shuffle."""
    for index in _blocks(benchmark, share, block):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[r[0] for r in _hits(batch.column("text"), held.value)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

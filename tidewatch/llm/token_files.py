"""Token ids in binary files: fixed-width bit packing with block offsets.

A file holds the ids of consecutive documents. Each id takes the fewest bits that hold the
vocabulary, little-endian within 64-bit words; blocks of ``BLOCK`` ids start at offsets that the file
lists, so any range of ids is read by fetching and unpacking only its blocks with numpy.

Layout, all numbers little-endian: ``MAGIC``; the blocks; document ids (int64); a byte per document,
1 if its id is not null; ends of the documents counted in ids (int64); block offsets (uint64);
the footer (bits, ids, documents, blocks as uint64, crc32 of the tables as uint64, ``MAGIC``).

Nulls and edge cases: a null text counts as empty and has the end id alone; null document ids come
first; repeated rows are all written; an empty table gives no file. Further columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.arrays import as_strings
from tidewatch.llm.encoding import encoder
from tidewatch.llm.folders import create, open_random, shared_folder, written

MAGIC = b"TWTOKEN1"
FOOTER = struct.Struct("<5Q8s")
BLOCK = 1 << 16

MANIFEST = "file_no int, path string, n_docs long, n_tokens long, bytes long"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a bit string, padded to a multiple of 64 ids."""
    rows = -(-len(ids) // 64)
    grid = np.zeros((rows, 64), np.uint64)
    grid.reshape(-1)[: len(ids)] = ids
    out = np.zeros((rows, bits), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[:, word] |= grid[:, k] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= grid[:, k] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    out = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, k] = value & mask
    return out.reshape(-1)[:count]


class TokenWriter:
    """Writes one file; holds one block of ids and the document table."""

    def __init__(self, uri: str, bits: int) -> None:
        self.out, self.bits, self.size = create(uri), bits, len(MAGIC)
        self.out.write(MAGIC)
        self.held, self.n_held, self.total = [], 0, 0
        self.doc_ids, self.known, self.lengths, self.blocks = [], [], [], []

    def add(self, doc_ids: np.ndarray, known: np.ndarray, ids: np.ndarray, lengths: np.ndarray):
        self.doc_ids.append(doc_ids)
        self.known.append(known)
        self.lengths.append(lengths)
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        if self.n_held >= BLOCK:
            self._flush(self.n_held // BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.held)
        for k in range(count):
            self._block(ids[k * BLOCK : (k + 1) * BLOCK])
        rest = ids[count * BLOCK :]
        self.held, self.n_held = [rest], len(rest)

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.blocks.append(self.size)
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple[int, int, int]:
        """Documents, ids and bytes written."""
        if self.n_held:
            self._block(np.concatenate(self.held))
        lengths = np.concatenate(self.lengths)
        tables = b"".join([
            np.concatenate(self.doc_ids).astype("<i8").tobytes(),
            np.concatenate(self.known).astype(np.uint8).tobytes(),
            np.cumsum(lengths).astype("<i8").tobytes(),
            np.array(self.blocks, "<u8").tobytes(),
        ])
        foot = FOOTER.pack(
            self.bits, self.total, len(lengths), len(self.blocks), zlib.crc32(tables), MAGIC
        )
        self.out.write(tables + foot)
        self.out.close()
        return len(lengths), self.total, self.size + len(tables) + len(foot)


class TokenReader:
    """Random access to one file."""

    def __init__(self, uri: str) -> None:
        self.file = open_random(uri)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        self.bits, self.total, docs, blocks, crc, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        length = docs * 17 + blocks * 8
        self.file.seek(size - FOOTER.size - length)
        tables = self.file.read(length)
        if zlib.crc32(tables) != crc:
            raise ValueError(f"{uri}: its tables are damaged")
        self.doc_ids = np.frombuffer(tables, "<i8", docs)
        self.known = np.frombuffer(tables, np.uint8, docs, docs * 8).astype(bool)
        self.ends = np.frombuffer(tables, "<i8", docs, docs * 9)
        self.blocks = np.frombuffer(tables, "<u8", blocks, docs * 17)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids at places begin to end, from the blocks that hold them."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // BLOCK, (end - 1) // BLOCK
        parts = []
        for k in range(first, last + 1):
            count = min(BLOCK, self.total - k * BLOCK)
            self.file.seek(int(self.blocks[k]))
            parts.append(unpack(self.file.read(-(-count // 64) * 8 * self.bits), self.bits, count))
        return np.concatenate(parts)[begin - first * BLOCK : end - first * BLOCK]

    def close(self) -> None:
        self.file.close()


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append an end id to the ids of each document."""
    return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1


def encoded(
    batch: pa.RecordBatch, vocabulary: str, end_id: int, special_tokens: bool = False,
    size: int = 1 << 22,
):
    """Blocks of (doc ids, known, ids, lengths) of the rows of a batch with doc_id and text."""
    column = as_strings(batch.column("text"))
    doc_ids = batch.column("doc_id")
    known = np.asarray(doc_ids.is_valid())
    values = np.asarray(doc_ids.fill_null(0)).astype(np.int64)
    code = encoder(vocabulary, special_tokens=special_tokens)
    begin, held, rows = 0, [], column.to_pylist()
    total = 0
    for row, text in enumerate(rows):
        held.append(text)
        total += len(text)
        if total >= size or row == len(rows) - 1:
            ids, lengths = with_end(*code.encode(held), end_id)
            yield values[begin : row + 1], known[begin : row + 1], ids, lengths
            begin, held, total = row + 1, [], 0


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, special_tokens: bool = False
) -> DataFrame:
    """Encode the texts of ``docs`` and write token files in ascending order of ``doc_id``.

    The string of a special token in a text is ordinary text, or with ``special_tokens`` that token.

    Returns the manifest (``MANIFEST``), a row per file in order. Each task writes one file under a
    name of its own, and the manifest is kept by Spark's committer: it names the files of the
    attempts that counted, and what a lost attempt has left is never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out, uri = TaskContext.get().partitionId(), None, ""
        for batch in batches:
            for doc_ids, known, ids, lengths in encoded(batch, vocabulary, end_id, special_tokens):
                if out is None:
                    uri = f"{folder}/tokens-{number:06d}-{uuid.uuid4().hex}.bin"
                    code = encoder(vocabulary, special_tokens=special_tokens)
                    size = max(code.vocabulary, end_id + 1)
                    out = TokenWriter(uri, bits_for(size))
                out.add(doc_ids, known, ids, lengths)
        if out is not None:
            n_docs, n_tokens, size = out.close()
            yield pa.RecordBatch.from_pydict(
                {"file_no": pa.array([number], pa.int32()), "path": [uri], "n_docs": [n_docs],
                 "n_tokens": [n_tokens], "bytes": [size]}
            )

    # the further keys only split rows that share one id over several ranges
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"),
    )
    order = ["doc_id", "tie", "place"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, chunk: int = 1 << 20) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and ids_crc32 (``DIGEST``)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _digest(row["path"], row["start"], chunk)

    order = Window.orderBy("file_no")  # a row per file
    before = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("start", F.coalesce(before, F.lit(0)))
    return files.select("path", "start").repartition(max(1, manifest.count())).mapInArrow(read, DIGEST)


def _digest(path: str, start: int, chunk: int) -> Iterator[pa.RecordBatch]:
    file = TokenReader(path)
    begins = np.concatenate([[0], file.ends[:-1]])
    row = 0
    while row < len(file.ends):
        stop = max(row + 1, int(np.searchsorted(file.ends, begins[row] + chunk, "right")))
        crcs = []
        if stop == row + 1:  # perhaps longer than a chunk
            crc = 0
            for at in range(begins[row], file.ends[row], chunk):
                crc = zlib.crc32(file.ids(at, min(at + chunk, file.ends[row])).astype("<u4"), crc)
            crcs.append(crc)
        else:
            ids = file.ids(int(begins[row]), int(file.ends[stop - 1])).astype("<u4")
            base = begins[row]
            for k in range(row, stop):
                crcs.append(zlib.crc32(ids[begins[k] - base : file.ends[k] - base]))
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(file.doc_ids[row:stop], mask=~file.known[row:stop]),
            "start": begins[row:stop] + start,
            "n_tokens": file.ends[row:stop] - begins[row:stop],
            "ids_crc32": np.array(crcs, np.int64),
        })
        row = stop
    file.close()


def token_output(
    docs: DataFrame, vocabulary: str, end_id: int = 2, special_tokens: bool = False
) -> DataFrame:
    """Write token files to the shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, vocabulary, end_id, special_tokens))

"""Product codes of vectors, with codebook entries found by equal-average search.

By the Cauchy-Schwarz inequality, two parts of d components whose sums differ by g have a squared
distance of at least g * g / d. The entries of a part's codebook are sorted by their sums; the search
starts where a vector's own sum falls and goes outward on both sides, and a side ends when its bound
is strictly over the best distance so far. Entries beyond can't win or tie, so the nearest entry, and
among equally near ones that of the lowest index, is always found.

All arithmetic is on whole numbers. A task takes vectors by the batch; between rounds only the sums
and counts of each entry, as many numbers as the codebooks have, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.folders import written

#: Up to so many labels their totals are broadcast; of more, a label's rows are dealt to so many pieces.
FEW_LABELS, PIECES = 10_000, 16


def search(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance) for each row of ``parts``, and the distances taken."""
    d = parts.shape[1]
    order = np.argsort(entries.sum(axis=1), kind="stable")
    sums = entries.sum(axis=1)[order]
    own = parts.sum(axis=1)
    best = np.full(len(parts), np.iinfo(np.int64).max // d)
    which = np.full(len(parts), len(entries))
    middle = np.searchsorted(sums, own)
    every = np.arange(len(parts))
    sides, taken = [(every, middle - 1, -1), (every, middle, 1)], 0
    while sides:
        further = []
        for rows, place, step in sides:
            inside = (place >= 0) & (place < len(order))
            rows, place = rows[inside], place[inside]
            gap = sums[place] - own[rows]
            reached = gap * gap <= best[rows] * d  # ends only where gap * gap / d is strictly more
            rows, place = rows[reached], place[reached]
            if not len(rows):
                continue
            index = order[place]
            away = parts[rows] - entries[index]
            away = np.einsum("ij,ij->i", away, away)
            taken += len(rows)
            wins = (away < best[rows]) | ((away == best[rows]) & (index < which[rows]))
            best[rows[wins]], which[rows[wins]] = away[wins], index[wins]
            further.append((rows, place + step, step))
        sides = further
    return which, best, taken


def largest(width: int, parts: int) -> int:
    """Components saturate here, so that no square or sum of a vector passes 64 bits."""
    return 2**29 // max(width, int(np.ceil((width * parts) ** 0.5)))


def whole_numbers(vectors: np.ndarray, scale: float, parts: int) -> np.ndarray:
    """floor(scale * x) of an array (n, dimension) as (n, parts, width)."""
    width = vectors.shape[1] // parts
    end = largest(width, parts)
    return np.clip(np.floor(vectors * scale), -end, end).astype(np.int64).reshape(-1, parts, width)


def finite_vectors(df: DataFrame, column: str) -> DataFrame:
    """The rows with a vector that is not null or empty and holds no null, NaN or infinite component."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad)


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        column = batch.column("vector")
        yield batch, column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def updated(kept: DataFrame, books: np.ndarray, scale: float) -> np.ndarray:
    """``books`` (part, entry, component) after one round: floors of the means of what is nearest."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for _, vectors in _batches(batches, parts * width):
            x = whole_numbers(vectors, scale, parts)
            for p in range(parts):
                which, _, _ = search(x[:, p], books[p])
                np.add.at(sums[p], which, x[:, p])
                counts[p] += np.bincount(which, minlength=entries)
        p, e = np.nonzero(counts)
        for c in range(width):
            yield pa.RecordBatch.from_pydict({
                "part": p, "entry": e, "place": np.full(len(p), c), "total": sums[p, e, c], "n": counts[p, e],
            })

    found = kept.select("vector").mapInArrow(run, "part long, entry long, place long, total long, n long")
    totals = found.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n")
    )
    out = books.copy()
    for r in totals.collect():  # as many rows as the codebooks have numbers
        out[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0
) -> DataFrame:
    """Per vector of ``df`` (vec_id, embedding, label): vec_id, code, error, label_error, codebooks_sha256.

    Each component becomes floor(scale * x), each vector ``parts`` equal parts. A part's codebook
    starts as that part of the ``entries`` vectors of smallest vec_id; each round assigns every part
    to its nearest entry (ties to the lower index) and replaces an entry by the floors of its parts'
    means; unused entries stay. ``code`` has two hex digits a part, ``error`` sums squared distances.

    Edge cases: rows whose vector is null, empty, or holds a null, NaN or infinite component are
    dropped, and so are those of another length than the vector of the smallest vec_id; that length
    must be a multiple of ``parts``. With fewer vectors than ``entries`` the codebooks are as short.
    Components beyond ``largest`` (2^26 for 64 dimensions) saturate; a label_error beyond 64 bits is
    null. Repeated rows count and come back as often as they came; of equal vec_ids the smaller
    vector comes first, null vec_ids come last. Null labels are one label. An empty table gives an
    empty one. Other columns are ignored, whatever their names. There are no texts.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits")
    spark = df.sparkSession
    label = dict(df.dtypes)["label"]
    vectors = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector")
    )
    vectors = finite_vectors(vectors, "vector")
    first = [
        r["vector"] for r in
        vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    ]
    schema = f"vec_id long, label {label}, code string, error long"
    if not first:
        none = spark.createDataFrame([], f"{schema}, label_error long, codebooks_sha256 string")
        return none.drop("label")
    dimension = len(first[0])
    if dimension % parts:
        raise ValueError(f"vectors of {dimension} components can't be cut into {parts} equal parts")
    kept = vectors.where(F.size("vector") == dimension)
    if any(len(v) != dimension for v in first):
        first = [
            r["vector"] for r in
            kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
        ]
    books = whole_numbers(np.array(first), scale, parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = updated(kept, books, scale)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{k:02x}" for k in range(256)], "U2")
        for batch, found in _batches(batches, dimension):
            x = whole_numbers(found, scale, parts)
            code, error = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for p in range(parts):
                code[:, p], away, _ = search(x[:, p], books[p])
                error += away
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "code": pa.array(["".join(row) for row in digits[code]], pa.string()),
                "error": error,
            })

    coded = written(kept.mapInArrow(encode, schema), "vector-codes")
    totals = written(
        coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "vector-labels"
    )
    # the labels' own number decides: a short list goes to every task, a long one meets rows in pieces
    if totals.count() <= FEW_LABELS:
        pieces, totals = 1, F.broadcast(totals.withColumn("piece", F.lit(0)))
    else:
        pieces = PIECES
        totals = totals.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    totals = totals.withColumnRenamed("label", "of")
    rows = coded.withColumn("at", F.pmod(F.xxhash64("vec_id", "code"), F.lit(pieces)).cast("int"))
    met = rows.join(totals, rows["label"].eqNullSafe(totals["of"]) & (rows["at"] == totals["piece"]))
    return met.select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )

"""Quality rules: counts per document, and cross-document line frequency.

Lines are normalised (A-Z in lower case, digits as 0, white space as one space) and hashed; the
distinct documents that hold a line are counted per host (here: source), where documents with equal
texts are one; lines above the limit, a share of the host's distinct documents, are removed; and
documents of which too few words remain are rejected, as are those that fail the base rules.

Near copies would make each other's lines frequent. Documents that would be rejected for their
frequent lines and have two of the longest three of these in common therefore count about as one, in
the lines' counts and in the host's size: each weighs one by the largest such group it is in. One line
in common makes no near copies: pages that hold little besides it are what the rule is for.

Two steps: one pass over the texts makes a small row per document (counts, its distinct line hashes
and the words under each), which is written to the shared folder; the rest works on that table. A
frequent line or a group of copies is pre-aggregated before each shuffle, and the distinct step is
keyed by host, line and document, so a line that a third of all documents share is dealt evenly.

Nulls and edge cases: a null or empty text has no words and fails the base rules; a null host is a
host of its own; repeated rows get equal results; an empty table gives no rows; further columns are
kept by ``quality_filter`` and ignored by ``quality_rules``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrays import as_strings, buffers, chain, hash_runs, mix, row_blocks, words
from tidewatch.llm.folders import written

MEASURES = (
    "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<line:long,words:int>>"
)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"[#*$%&|<>]"[1:-1])] = True
NORMAL = np.arange(256, dtype=np.uint8)
NORMAL[ord("A") : ord("Z") + 1] += 32
NORMAL[ord("0") : ord("9") + 1] = ord("0")
WINDOW = 5


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _keyed(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    return mix(hashes + (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _repeated_words(first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per row, its words in windows that occur twice or more in it."""
    n_rows, n_words = len(first) - 1, len(hashes)
    owner = np.repeat(np.arange(n_rows), np.diff(first))
    windows = chain(hashes, WINDOW)
    inside = owner[: len(windows)] == owner[WINDOW - 1 :] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    keys = _keyed(owner[at], windows[at])
    order = np.argsort(keys)
    equal = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edges = np.zeros(n_words + 1, np.int64)
    begins = at[twice]
    edges[begins] += 1  # a window begins once at a word
    edges[begins + WINDOW] -= 1
    return _per_row(np.cumsum(edges[:n_words]) > 0, first)


def measure_block(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
    """Counts per text, and (line hashes, words, lines per text) of their distinct lines."""
    n_rows = len(offsets) - 1
    begins, ends, first = words(data, offsets)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[begins] += 1
    in_word[ends] -= 1  # words that touch at a row's end cancel out
    points = (np.cumsum(in_word[:-1]) > 0) & ((data & 0xC0) != 0x80)

    breaks = np.flatnonzero(data == 0x0A)
    line_begins = np.union1d(offsets[:-1], breaks + 1)
    line_begins = line_begins[line_begins < offsets[-1]]
    stops = np.searchsorted(offsets, line_begins, "right")  # the row of each line, plus one
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, line_begins)]
    line_ends = np.minimum(next_break, offsets[stops])
    word_from, word_to = np.searchsorted(begins, line_begins), np.searchsorted(begins, line_ends)
    real = word_to > word_from
    rows = stops[real] - 1

    exact = _keyed(rows, hash_runs(data, line_begins[real], line_ends[real]))
    _, kept = np.unique(exact, return_index=True)
    n_lines = np.bincount(rows, minlength=n_rows)
    n_dup = n_lines - np.bincount(rows[kept], minlength=n_rows)

    normal = hash_runs(NORMAL[data], begins, ends)
    line = hash_runs(normal, word_from[real], word_to[real])
    keys, kept, place = np.unique(_keyed(rows, line), return_index=True, return_inverse=True)
    under = np.bincount(place, (word_to - word_from)[real], len(keys)).astype(np.int64)
    order = np.argsort(rows[kept], kind="stable")
    distinct = (
        line[kept][order].view(np.int64), under[order], np.bincount(rows[kept], minlength=n_rows)
    )
    counts = {
        "n_words": np.diff(first),
        "word_chars": _per_row(points, offsets),
        "n_symbols": _per_row(SYMBOLS[data], offsets),
        "n_dup_lines": n_dup,
        "n_repeat_words": _repeated_words(first, hash_runs(data, begins, ends)),
    }
    return counts, distinct


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def measure(docs: DataFrame, host: str | Column = "source") -> DataFrame:
    """A row per document (``MEASURES``), without its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_strings(batch.column("text"))
            for begin, end in row_blocks(texts):
                data, offsets = buffers(texts.slice(begin, end - begin))
                counts, (line, under, sizes) = measure_block(data, offsets)
                structs = pa.StructArray.from_arrays(
                    [pa.array(line), pa.array(under.astype(np.int32))], ["line", "words"]
                )
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(begin, end - begin),
                    "host": batch.column("host").slice(begin, end - begin),
                    "text_key": batch.column("text_key").slice(begin, end - begin),
                    **counts,
                    "lines": pa.ListArray.from_arrays(pa.array(ends), structs),
                })

    host = F.col(host) if isinstance(host, str) else host
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"), text_key().alias("text_key"),
    )
    return texts.mapInArrow(run, MEASURES)


def base_failed(min_words: int, max_repeat_percent: int) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )


def _held(measured: DataFrame) -> DataFrame:
    lines = measured.select("host", "text_key", F.explode("lines").alias("l"))
    return lines.select("host", "text_key", F.col("l.line").alias("line"), F.col("l.words").alias("words"))


def _pair(x: Column, y: Column) -> Column:
    return F.when(x.isNotNull() & y.isNotNull(), F.xxhash64(F.least(x, y), F.greatest(x, y)))


def frequent_lines(
    measured: DataFrame, max_share: float, least_docs: int, least_share: float
) -> DataFrame:
    """(host, line) of lines in more than ``max_share`` of a host's documents, near copies as one."""
    held = _held(measured)
    # lines in up to least_docs documents are never frequent
    counts = written(
        held.select("host", "line", "text_key").distinct().groupBy("host", "line").count()
        .where(F.col("count") > least_docs), "line-counts",
    )
    texts = measured.groupBy("host", "text_key").agg(F.max("n_words").alias("n_words"))
    sizes = texts.groupBy("host").agg(F.count("*").alias("docs"))

    def limit(docs: Column) -> Column:
        return F.greatest(F.lit(float(least_docs)), max_share * docs)

    first = counts.join(sizes, "host").where(F.col("count") > limit(F.col("docs"))).select("host", "line")
    hits = held.join(first, ["host", "line"]).groupBy("host", "text_key", "line").agg(F.max("words").alias("words"))
    # a text's frequent lines are at most as many as its lines
    longest = F.slice(F.sort_array(F.collect_list(F.struct("words", "line")), False), 1, 3)
    pairs = F.array(*(_pair(F.get("longest.line", a), F.get("longest.line", b)) for a, b in ((0, 1), (0, 2), (1, 2))))
    gone = hits.groupBy("host", "text_key").agg(F.sum("words").alias("gone"), longest.alias("longest"))
    keys = gone.join(texts, ["host", "text_key"]).where(
        F.col("n_words") - F.col("gone") < least_share * F.col("n_words")
    ).select("host", "text_key", F.explode(pairs).alias("pair")).where("pair is not null")
    groups = keys.groupBy("host", "pair").agg(F.count("*").alias("alike"))
    # what each near copy counts less than a whole document
    copies = written(
        keys.join(groups, ["host", "pair"]).groupBy("host", "text_key")
        .agg((1 - 1 / F.max("alike")).alias("less")), "near-copies",
    )
    fewer = held.join(copies, ["host", "text_key"]).groupBy("host", "text_key", "line").agg(
        F.max("less").alias("less")
    ).groupBy("host", "line").agg(F.sum("less").alias("fewer"))
    smaller = copies.groupBy("host").agg(F.sum("less").alias("smaller"))
    own = F.round(F.col("count") - F.coalesce("fewer", F.lit(0.0)), 6)
    size = F.round(F.col("docs") - F.coalesce("smaller", F.lit(0.0)), 6)
    return counts.join(sizes.join(smaller, "host", "left"), "host").join(
        fewer, ["host", "line"], "left"
    ).where(own > limit(size)).select("host", "line")


def quality_rules(
    docs: DataFrame, host: str | Column = "source", max_docs: int | None = None, least_share: float = 0.2,
    min_words: int = 10, max_repeat_percent: int = 20, max_share: float = 0.05, least_docs: int = 5,
) -> DataFrame:
    """Verdict per document: ``base_failed``, ``removed_words`` and ``kept``.

    A line is removed where more than ``max_share`` of the distinct documents of its host hold it, and
    more than ``least_docs`` (near copies count as one); with ``max_docs``, where more than so many
    distinct texts do, whatever the host's size. A document is depleted if less than ``least_share``
    of its words remain.
    """
    measured = written(measure(docs, host), "quality")
    held = _held(measured)
    if max_docs is None:
        frequent = frequent_lines(measured, max_share, least_docs, least_share)
    else:
        frequent = held.select("host", "line", "text_key").distinct().groupBy("host", "line").count().where(
            F.col("count") > max_docs
        ).drop("count")
    # of a text's copies each line counts once
    removed = held.join(frequent, ["host", "line"]).groupBy("host", "text_key", "line").agg(
        F.max("words").alias("words")
    ).groupBy("host", "text_key").agg(F.sum("words").alias("removed_words"))
    judged = measured.drop("lines").join(removed, ["host", "text_key"], "left")
    gone = F.coalesce("removed_words", F.lit(0))
    failed = base_failed(min_words, max_repeat_percent)
    depleted = F.col("n_words") - gone < least_share * F.col("n_words")
    return judged.withColumns({
        "removed_words": gone, "base_failed": failed, "kept": ~failed & ~depleted,
    })


def quality_filter(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that ``quality_rules`` keeps, with all their columns."""
    verdicts = quality_rules(docs, host, **limits)
    rejected = verdicts.where(~F.col("kept")).select("doc_id", "host", "text_key").distinct()
    keyed = docs.withColumns({
        "__host": F.coalesce(F.col(host).cast("string"), F.lit("")), "__text_key": text_key(),
    })
    same = (
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("r.doc_id"))
        & (F.col("d.__host") == F.col("r.host")) & (F.col("d.__text_key") == F.col("r.text_key"))
    )
    left = keyed.alias("d").join(rejected.alias("r"), same, "left_anti")
    return left.select(*docs.columns)

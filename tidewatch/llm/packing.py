"""Best-fit packing of documents into sequences by a linear grouping scheme.

Lengths are at most the capacity, so the histogram of lengths is small whatever the corpus, and the
plan is made from it alone: large lengths are cut into groups of equal cardinality and rounded up to
their group's largest; configurations of these few sizes are optimised by column generation; actual
lengths take the places of the rounded ones; and what is left, with the small lengths, goes by best
fit, longest first. The plan is a list of runs of equal sequences. Documents find their place by
their rank among those of equal length, which is counted per task and summed up by Spark.

Nulls and edge cases: a null text counts as empty (its end id alone); repeated rows are each packed;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.folders import written
from tidewatch.llm.token_files import encoded

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local long"
)


def cut_pieces(
    docs: DataFrame, vocabulary: str, capacity: int, end_id: int, special_tokens: bool = False
) -> DataFrame:
    """Pieces of all documents (``PIECES``), with their number among equal lengths of the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for doc_ids, known, ids, lengths in encoded(batch, vocabulary, end_id, special_tokens):
                counts = -(-lengths // capacity)
                row = np.repeat(np.arange(len(lengths)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = lengths - (counts - 1) * capacity  # the first piece takes the rest
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                at = (np.cumsum(lengths) - lengths)[row] + start
                wide = ids.astype("<u4")
                crcs = [zlib.crc32(wide[a:b]) for a, b in zip(at, at + length, strict=True)]
                order = np.argsort(length, kind="stable")
                same = length[order]
                begin = np.searchsorted(same, same)
                local = np.empty(len(row), np.int64)
                local[order] = np.arange(len(row)) - begin + seen[same]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids[row], mask=~known[row]),
                    "piece": piece.astype(np.int32), "start": start, "length": length,
                    "ids_crc32": np.array(crcs, np.int64),
                    "task": np.full(len(row), task, np.int32), "local": local,
                })

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(cut, PIECES)


# ---------------------------------------------------------------- the plan, from the histogram


class _Runs:
    """Runs of sequences with equal contents, by the room they have left."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_room: dict[int, list[tuple[int, tuple]]] = {}
        self.rooms: list[int] = []

    def add(self, count: int, lengths: tuple, room: int) -> None:
        if count:
            if room not in self.by_room:
                self.by_room[room] = []
                self.rooms.insert(bisect_left(self.rooms, room), room)
            self.by_room[room].append((count, lengths))

    def take(self, length: int) -> tuple[int, tuple, int] | None:
        """A run of the tightest sequences that have room for ``length``."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        count, lengths = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room]
            self.rooms.pop(at)
        return count, lengths, room

    def best_fit(self, length: int, count: int) -> None:
        while count:
            run = self.take(length)
            if run is None:
                each = self.capacity // length
                full, rest = divmod(count, each)
                self.add(full, ((length, each),), self.capacity - each * length)
                if rest:
                    self.add(1, ((length, rest),), self.capacity - rest * length)
                return
            n, lengths, room = run
            each = min(room // length, -(-count // n))
            used = min(n, count // each)
            self.add(n - used, lengths, room)
            self.add(used, (*lengths, (length, each)), room - each * length)
            count -= used * each


def _configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 400):
    """(copies, slots per size) of the configurations in an optimum of the relaxed problem.

    Column generation: the basis starts with one size per configuration; each round prices a new
    one by an unbounded knapsack over the sizes and exchanges it.
    """
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amounts = counts / np.diag(basis)
    smallest = int(sizes.min())
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(smallest, capacity + 1):
            fits = sizes <= room
            gains = best[room - sizes[fits]] + prices[fits]
            top = int(np.argmax(gains))
            if gains[top] > best[room - 1] + 1e-12:
                best[room], choice[room] = gains[top], np.flatnonzero(fits)[top]
            else:
                best[room], choice[room] = best[room - 1], -1
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        while room >= smallest:
            if choice[room] < 0:
                room -= 1
            else:
                column[choice[room]] += 1
                room -= sizes[choice[room]]
        direction = np.linalg.solve(basis, column)
        limits = np.full(k, np.inf)
        positive = direction > 1e-9
        limits[positive] = amounts[positive] / direction[positive]
        leaves = int(np.argmin(limits))
        step = limits[leaves]
        amounts = np.maximum(amounts - step * direction, 0)
        amounts[leaves] = step
        basis[:, leaves] = column
    return [(int(a), basis[:, j].astype(int)) for j, a in enumerate(np.floor(amounts + 1e-9)) if a]


def plan_packing(
    histogram: dict[int, int], capacity: int, groups: int = 48, large_share: float = 0.25
) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, as runs of ranks.

    Run i holds pieces of ``length[i]`` with ranks ``rank[i]`` to ``rank[i] + count[i]``:
    piece r of the run goes to sequence ``sequence[i] + r // each[i]`` at place
    ``offset[i] + (r % each[i]) * length[i]``.
    """
    runs = _Runs(capacity)
    left = np.zeros(capacity + 1, np.int64)
    left[list(histogram)] = list(histogram.values())
    runs.add(int(left[capacity]), ((capacity, 1),), 0)
    left[capacity] = 0
    lengths = np.flatnonzero(left)[::-1]
    lengths = lengths[lengths > capacity * large_share]
    if len(lengths):
        totals = np.cumsum(left[lengths])
        # group ends at equal cardinality, moved to where a length ends
        goals = np.arange(1, groups + 1) * totals[-1] / groups
        stops = np.unique(np.searchsorted(totals, goals - 1e-9)) + 1
        starts = np.concatenate([[0], stops[:-1]])
        sizes = lengths[starts]
        counts = np.diff(np.concatenate([[0], totals[stops - 1]])).astype(float)
        for copies, slots in _configurations(sizes, counts, capacity):
            _substitute(runs, left, sizes, copies, slots, capacity)
    for n in np.flatnonzero(left)[::-1]:
        runs.best_fit(int(n), int(left[n]))

    out: dict[str, list[int]] = {k: [] for k in ("length", "rank", "count", "sequence", "offset", "each")}
    ranks: dict[int, int] = {}
    sequence = 0
    for room in runs.rooms:
        for count, contents in runs.by_room[room]:
            offset = 0
            for n, each in contents:
                rank = ranks.get(n, 0)
                for key, value in zip(out, (n, rank, count * each, sequence, offset, each), strict=True):
                    out[key].append(value)
                ranks[n] = rank + count * each
                offset += n * each
            sequence += count
    order = np.lexsort((out["rank"], out["length"]))
    return {key: np.array(values, np.int64)[order] for key, values in out.items()}


def _substitute(
    runs: _Runs, left: np.ndarray, sizes: np.ndarray, copies: int, slots: np.ndarray, capacity: int
) -> None:
    """Fill ``copies`` of a configuration with actual lengths, in as few runs as they allow.

    Each slot takes the largest length left that its rounded size covers, the last slot the largest
    that still fits: so the room that rounding up left open is used.
    """
    needs = [int(sizes[g]) for g in np.flatnonzero(slots) for _ in range(slots[g])]
    while copies:
        used: dict[int, int] = {}
        room, free = capacity, left.copy()
        for k, size in enumerate(needs):
            fits = np.flatnonzero(free[: (room if k == len(needs) - 1 else size) + 1])
            if not len(fits):
                break
            n = int(fits[-1])
            used[n] = used.get(n, 0) + 1
            free[n] -= 1
            room -= n
        if not used:
            return
        now = min(copies, *(int(left[n]) // each for n, each in used.items()))
        for n, each in used.items():
            left[n] -= now * each
        runs.add(now, tuple(used.items()), room)
        copies -= now


# ---------------------------------------------------------------- placing the documents


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, groups: int = 48,
    special_tokens: bool = False,
) -> DataFrame:
    """All pieces of ``docs`` (doc_id, text) with their sequence and place in it.

    The string of a special token in a text is ordinary text, or with ``special_tokens`` that token.
    """
    pieces = written(cut_pieces(docs, vocabulary, capacity, end_id, special_tokens), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = plan_packing(histogram, capacity, groups)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # runs in order of (length, rank): one search over both where the key fits a double
        first = np.searchsorted(plan["length"], np.arange(capacity + 2))
        scale = int(max([1, *(plan["rank"] + plan["count"])]))
        keys = plan["length"].astype(float) * scale + plan["rank"]
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            if scale < 2**40:
                run = np.searchsorted(keys, length.astype(float) * scale + rank, "right") - 1
            else:
                run = np.array([
                    first[n] + np.searchsorted(plan["rank"][first[n] : first[n + 1]], r, "right") - 1
                    for n, r in zip(length, rank, strict=True)
                ], np.int64)
            inner = rank - plan["rank"][run]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "rank"}
            columns["sequence_id"] = plan["sequence"][run] + inner // plan["each"][run]
            columns["offset"] = plan["offset"][run] + inner % plan["each"][run] * length
            yield pa.RecordBatch.from_pydict(columns)

    by_task = pieces.groupBy("task", "length").count()
    before = Window.partitionBy("length").orderBy("task")  # a row per task
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select(
        "task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    ranked = pieces.join(base, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("local")).alias("rank"),
    )
    return ranked.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )

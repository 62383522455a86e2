"""SimHash near-duplicates: links between 64-bit fingerprints by vantage-point trees.

The Hamming distance is a sum over disjoint parts of the bits. For a vantage point v, a point x and a
query q, the triangle inequality gives on each part |d(v, q) - d(v, x)| <= d(q, x), so the gaps on
different parts add up: where their sum passes the limit, q and x don't link. Each level of a tree
cuts its points into shells by their distance from a vantage point on one part; a query goes on into
the shells its remaining gap reaches. Nothing but these bounds prunes, and each pair left is compared
in full, so the links are exact.

One tree over all fingerprints cuts them into shards. Each fingerprint is a point of one shard and a
query to that one and to the shards of higher number that its ball overlaps; each shard builds its
own tree around other vantage points. Only the forest of each shard's links leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components, local_roots
from tidewatch.llm.folders import written

BITS = 64
#: Aimed number of points in a shard. A task holds its points and queries, 8 bytes each; the larger the
#: shards, the fewer of them a ball overlaps, and the fewer copies of a fingerprint travel.
SHARD_POINTS = 65_536
#: Fingerprints that choose the vantage points and cuts of the shards; they bear on balance alone.
SAMPLE = 65_536
#: Bits of a part: narrower ones prune more in deep trees, wider ones in shallow trees.
WIDTH = 16
#: A node with fewer pairs is compared in full.
FEW_PAIRS = 1 << 19
#: So many links wait to be united, and so many bits are summed at a time.
BLOCK = 1 << 19


def parts(width: int) -> list[np.uint64]:
    """Masks of disjoint runs of bits that make up a fingerprint."""
    return [np.uint64(((1 << width) - 1) << k) for k in range(0, BITS, width)]


# ------------------------------------------------------------------ fingerprints


def shingle_hashes(text: str | None, n: int, seed: int) -> np.ndarray:
    """XXH64 of each run of n words, repeats included; of all words if there are fewer than n."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return np.empty(0, np.uint64)
    line = memoryview(b" ".join(words))
    begin = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
    n = min(n, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(begin[: len(words) - n + 1].tolist(), (begin[n:] - 1).tolist(), strict=True)
    return np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, len(words) - n + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), BLOCK // BITS):
        some = hashes[k : k + BLOCK // BITS].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of each row of ``docs`` (doc_id, text): the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array(
                [fingerprint(shingle_hashes(t.as_py(), n, seed)) for t in batch.column("text")], np.uint64
            )
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "fp": pa.array(prints.view(np.int64))}
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------ the tree that makes shards


@dataclass
class Node:
    """Shells around ``vantage`` on the bits of ``mask``; shell k ends at distance ``ends[k]``."""

    vantage: np.uint64
    mask: np.uint64
    ends: list[int]
    children: list[Node | int]


def distance(x: np.ndarray, vantage, mask) -> np.ndarray:
    return np.bitwise_count((x ^ vantage) & mask).astype(np.int16)


def shard_tree(sample: np.ndarray, total: int, points: int = SHARD_POINTS) -> tuple[Node | int, int]:
    """A tree whose leaves are shards of about ``points`` of the ``total`` fingerprints, and their number.

    ``sample`` is in random order. A node that isn't small enough is cut into shells of like size on
    the next part; equal distances stay together, so a shard can come out larger.
    """
    masks = parts(WIDTH)
    shards = 0

    def build(some: np.ndarray, level: int) -> Node | int:
        nonlocal shards
        wanted = len(some) * total / max(1, len(sample)) / points
        if wanted <= 1 or level == 4 * len(masks):  # each part can serve again, from another vantage point
            shards += 1
            return shards - 1
        vantage, mask = some[level % len(some)], masks[level % len(masks)]
        away = distance(some, vantage, mask)
        least = len(some) / min(8, int(np.ceil(wanted)))
        ends, held = [], 0
        for d, n in enumerate(np.bincount(away, minlength=WIDTH + 1)):
            held += n
            if held >= least:
                ends.append(d)
                held = 0
        ends = [*ends[: -1 if held < least / 2 else None], WIDTH]
        shell = np.searchsorted(ends, away)
        return Node(vantage, mask, ends, [build(some[shell == k], level + 1) for k in range(len(ends))])

    return build(sample, 0), shards


def visits(tree: Node | int, x: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, shard, whether x is a point of it) for all shards that x's balls overlap."""
    found = []

    def descend(node: Node | int, level: int, rows: np.ndarray, left: np.ndarray, home: np.ndarray) -> None:
        if isinstance(node, int):
            found.append((rows, np.full(len(rows), node), home))
            return
        if level % (BITS // WIDTH) == 0:  # gaps add up over disjoint parts, not over one that serves again
            left = np.full(len(rows), limit, np.int16)
        away, low = distance(x[rows], node.vantage, node.mask), 0
        for end, child in zip(node.ends, node.children, strict=True):
            gap = np.maximum(0, np.maximum(low - away, away - end))
            go = left >= gap
            if go.any():
                descend(child, level + 1, rows[go], (left - gap)[go], (home & (gap == 0))[go])
            low = end + 1

    descend(tree, 0, np.arange(len(x)), np.full(len(x), limit, np.int16), np.ones(len(x), bool))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


# ------------------------------------------------------------------ the tree within a shard


def forest(points: np.ndarray, others: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that connect what links of ``points`` among themselves and with ``others`` connect.

    At most one edge for each fingerprint, however many links there are: they are united as they are
    found, and pairs that are connected already aren't compared.
    """
    nodes = np.concatenate([points, others])
    label = np.arange(len(nodes))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    masks = parts(WIDTH)
    room = np.empty(max(FEW_PAIRS, len(points)), np.uint64)

    def unite() -> None:
        nonlocal label, held
        if waiting:
            a, b = (label[np.concatenate(c)] for c in zip(*waiting, strict=True))
            moved, root = local_roots(a, b)
            new = np.arange(len(nodes))
            new[moved] = root
            label = new[label]
            waiting.clear()
        held = 0

    def compare(p: np.ndarray, q: np.ndarray) -> None:
        nonlocal held
        if (label[p] == label[p[0]]).all():
            q = q[label[q] != label[p[0]]]
        step = max(1, len(room) // len(p))
        x, y = nodes[p], nodes[q]
        for k in range(0, len(q), step):
            some = y[k : k + step, None]
            differ = room[: some.size * len(p)].reshape(len(some), len(p))
            np.bitwise_xor(some, x, out=differ)
            near = np.flatnonzero(np.bitwise_count(differ).ravel() <= limit)
            if len(near):
                waiting.append((q[k + near // len(p)], p[near % len(p)]))
                held += len(near)
                if held > BLOCK:
                    unite()

    def search(p: np.ndarray, q: np.ndarray, left: np.ndarray, level: int) -> None:
        if len(p) * len(q) <= FEW_PAIRS or level == 2 * len(masks):
            compare(p, q)
            return
        if level % len(masks) == 0:
            left = np.full(len(q), limit, np.int16)
        mask = masks[level % len(masks)]
        vantage = nodes[p[len(p) // 2]]
        away, asked = distance(nodes[p], vantage, mask), distance(nodes[q], vantage, mask)
        for d in np.unique(away):
            rest = left - np.abs(asked - d)
            go = rest >= 0
            if go.any():
                search(p[away == d], q[go], rest[go], level + 1)

    if len(points):
        search(np.arange(len(points)), np.arange(len(nodes)), np.empty(0), 0)
        unite()
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


# ------------------------------------------------------------------ over Spark


def _sample(distinct: DataFrame, total: int) -> np.ndarray:
    """About ``SAMPLE`` fingerprints, chosen and ordered by a hash; all if there are fewer."""
    keep = min(1.0, SAMPLE / max(1, total))
    chosen = distinct.select("fp", F.xxhash64("fp").alias("h")).where(
        F.col("h") <= F.lit(int(min(2**63 - 1, -(2**63) + keep * 2**64)))
    )
    rows = chosen.toArrow()
    order = np.argsort(rows.column("h").to_numpy())
    return rows.column("fp").to_numpy()[order].view(np.uint64)


def links(distinct: DataFrame, limit: int, points: int = SHARD_POINTS) -> DataFrame:
    """Edges (a, b) among the fingerprints of ``distinct`` (fp) whose components are those of all links."""
    total = distinct.count()
    sample = _sample(distinct, total)
    tree, shards = shard_tree(sample, total, points)
    # a shard that many visit is asked in pieces, each with all of its points
    row, shard, home = visits(tree, sample, limit)
    asked = np.bincount(shard[~home], minlength=shards) * (total / max(1, len(sample)))
    pieces = 1 + (asked // (8 * points)).astype(np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint64)
            row, shard, home = visits(tree, x, limit)
            own = np.empty(len(x), np.int64)
            own[row[home]] = shard[home]
            further = shard > own[row]  # of two shards, the one with the lower number asks
            guest = pa.RecordBatch.from_pydict({
                "shard": shard[further], "piece": row[further] % pieces[shard[further]],
                "home": np.zeros(int(further.sum()), bool), "fp": x[row[further]].view(np.int64),
            })
            yield guest
            times = pieces[own]
            piece = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_pydict({
                "shard": np.repeat(own, times), "piece": piece, "home": np.ones(len(piece), bool),
                "fp": np.repeat(x, times).view(np.int64),
            })

    def search(shard: pa.Table) -> pa.Table:
        x = shard.column("fp").to_numpy().view(np.uint64)
        home = shard.column("home").to_numpy()
        a, b = forest(np.sort(x[home]), x[~home], limit)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard long, piece long, home boolean, fp long")
    return dealt.groupBy("shard", "piece").applyInArrow(search, "a long, b long")


def simhash_components(
    docs: DataFrame, n: int = 5, limit: int = 3, seed: int = 42, points: int = SHARD_POINTS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits) and component_id.

    Two documents link when their fingerprints over shingles of ``n`` words differ in at most
    ``limit`` bits; component_id is the smallest doc_id that links reach.

    Edge cases: null, empty and blank texts have no words and fingerprint zero, and link like any
    others; a text of fewer than n words is one shingle. Of long texts every shingle counts; bits are
    summed in blocks. A bit set in exactly half of the hashes is not set. Repeated rows come back as
    often as they came. Null doc_ids take part in links, and never name a component that has another
    id. An empty table gives an empty one. Other columns are ignored, whatever their names.
    """
    prints = written(fingerprints(docs, n, seed), "simhash-prints")
    distinct = written(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")),
        "simhash-distinct",
    )
    roots = components(links(distinct, limit, points), "simhash-links").withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = written(named.join(ids, "root").select("fp", "copies", "component_id"), "simhash-named")
    # a fingerprint of a thousandth of all rows or more: fewer than 1,000 of them, met without a shuffle
    total = found.agg(F.sum("copies")).first()[0] or 0
    many = F.col("copies") > max(1000, total // 1000)
    met = prints.join(F.broadcast(found.where(many).withColumn("many", F.lit(True))), "fp", "left")
    few = met.where("many is null").select("doc_id", "fp").join(found.where(~many), "fp")
    rows = met.where("many").select("doc_id", "fp", "component_id").unionByName(
        few.select("doc_id", "fp", "component_id")
    )
    return rows.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )

"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents with equal n-gram sets are one class. Two classes can only reach the threshold if their
sizes are near and they share one of the rarest few n-grams of each, which is a fifth of the set for
0.8. So the columns are ordered rare first, by a count sketch over all documents, and the product is
taken in two steps:

1. Columns among each class's rarest. Classes that meet in such a column, within the size bound, are
   candidates; each set also has a bitmap of parities, of at least as many bits as it has n-grams, and as each n-gram in one set alone flips at most one bit, the bits by which two bitmaps
   differ bound the overlap from above. What is left makes blocks: sets of classes beyond which no
   link goes. Where many classes meet, the bitmaps are compared in tiles, see below.
2. Within a block, the product proper: overlap counts are accumulated over all columns, and pairs
   below the bounds that follow from their sizes are discarded. Large blocks are cut into tiles by
   size and hash, and each pair of tiles within the size bound is a product of its own.

A tile gives the edges of a spanning forest of its links; the components of all of them are the
result. No link is lost, no group is expanded into pairs, and nothing but the sketch (a fixed number
of counters) passes the driver. Sets are compared by 64-bit hashes of the n-grams, classes by 64-bit
hashes of sets.

Nulls and edge cases: null, empty and blank texts have no n-grams and are linked with nothing;
repeated rows are linked (equal sets); a null doc_id is never a component's id unless there is no
other; an empty table gives no rows; further columns are ignored by ``jaccard_components``, kept by
``one_of_each``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.arrays import as_strings, buffers, chain, hash_runs, mix, row_blocks, words
from tidewatch.llm.components import components, local_roots
from tidewatch.llm.folders import written

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SKETCH_BITS = 18
SLICE = 4096
REST = np.uint64(64 - SKETCH_BITS)
LOW = np.uint64((1 << (64 - SKETCH_BITS)) - 1)
#: Up to so many classes, the pairs of a column are rows; beyond, they are compared within a tile.
PAIRED = 8
#: Classes in a tile of the product, about.
TILE = 4096
EMPTY = np.zeros(0, np.uint64)


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its n-word runs, or of all its words if fewer."""
    begins, ends, first = words(data, offsets)
    hashes = hash_runs(LOWER[data], begins, ends)
    grams = chain(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(mix(chain(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(EMPTY)
    return out


def class_of(grams: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(grams ^ np.uint64(0xD1B54A32D192ED03)), dtype=np.uint64)
        return int(mix(np.array([total + np.uint64(len(grams))]))[0].view(np.int64))


def parities(grams: np.ndarray) -> bytes:
    """A bitmap with a bit for each remainder of the hashes, set if an odd number of them has it."""
    size = max(64, 1 << len(grams).bit_length())
    odd = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (in the last axis) as if made with fewer remainders."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    texts = as_strings(batch.column("text"))
    for begin, end in row_blocks(texts):
        yield begin, gram_sets(*buffers(texts.slice(begin, end - begin)), n)


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        text_key().alias("text_key"),
    )


def _survey(docs: DataFrame, n: int) -> DataFrame:
    """Per document its class and set size, and per task the slices of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        schema = pa.schema([
            ("doc_id", pa.int64()), ("text_key", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()),
            ("bits", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary()),
        ])
        for batch in batches:
            for begin, sets in _sets(batch, n):
                sketch += np.bincount(
                    (np.concatenate(sets) >> REST).astype(np.int64), minlength=len(sketch)
                )
                rows = len(sets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(begin, rows), batch.column("text_key").slice(begin, rows),
                    pa.array([class_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([parities(s) for s in sets], pa.binary()),
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ], schema=schema)
        parts = sketch.reshape(-1, SLICE).astype("<i8")
        yield pa.RecordBatch.from_arrays([
            *(pa.nulls(len(parts), pa.int64()) for _ in range(4)), pa.nulls(len(parts), pa.binary()),
            pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()),
        ], schema=schema)

    return _texts(docs).mapInArrow(
        run, "doc_id long, text_key long, cls long, n long, bits binary, slice int, counts binary"
    )


def _column_ranks(survey: DataFrame) -> np.ndarray:
    """The rank of each sketch bucket, rare first. A fixed number of counters reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, "<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            names=["slice", "counts"],
        )

    slices = survey.where("slice is not null").select("slice", "counts")
    # within a task first, then one task for each slice
    added = slices.mapInArrow(add, slices.schema).repartition("slice").mapInArrow(add, slices.schema)
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in added.collect():
        total[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], "<i8")
    ranks = np.empty(len(total), np.uint64)
    ranks[np.argsort(total, kind="stable")] = np.arange(len(total), dtype=np.uint64)
    return ranks


def _ranked(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Hashes renamed so that their order is rare first."""
    return np.sort((ranks[(grams >> REST).astype(np.int64)] << REST) | (grams & LOW))


def least_overlap(x, y, percent: int):
    """The overlap that sets of these sizes need."""
    return -(-percent * (x + y) // (100 + percent))


def _columns(docs: DataFrame, ranks, n: int, percent: int) -> DataFrame:
    """(gram, cls, n, place) for the rarest n-grams of each class that can have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task
        table = ranks.value
        for batch in batches:
            for _, sets in _sets(batch, n):
                keys, classes, sizes, places = [], [], [], []
                for grams in sets:
                    size = len(grams)
                    larger = size * 100 // percent  # the largest partner
                    if size == 0 or (larger == size and least_overlap(size, size, percent) == size):
                        continue
                    cls = class_of(grams)
                    if cls in seen:
                        continue
                    seen.add(cls)
                    count = size - -(-percent * size // 100) + 1
                    keys.append(_ranked(grams, table)[:count])
                    classes.append(np.full(count, cls, np.int64))
                    sizes.append(np.full(count, size, np.int32))
                    places.append(np.arange(count, dtype=np.int32))
                if keys:
                    yield pa.RecordBatch.from_pydict({
                        "gram": np.concatenate(keys).view(np.int64), "cls": np.concatenate(classes),
                        "n": np.concatenate(sizes), "place": np.concatenate(places),
                    })

    return _texts(docs).mapInArrow(run, "gram long, cls long, n int, place int")


def _meet(columns: DataFrame, percent: int) -> DataFrame:
    """Where classes meet: pairs (a, b) of columns that few have, members (gram, a) of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: np.zeros(0, np.int64) for k in ("gram", "cls", "n", "place")}
        long = None  # the column that the last batch ended in, if it has too many classes for pairs
        for batch in batches:
            rows = {k: np.concatenate([v, np.asarray(batch.column(k)).astype(np.int64)])
                    for k, v in held.items()}
            # the last column may go on; of a long one, what is known can be written already
            tail = int(np.searchsorted(rows["gram"], rows["gram"][-1]))
            last = {k: v[tail:] for k, v in rows.items()}
            yield from _meetings({k: v[:tail] for k, v in rows.items()}, long, percent)
            if tail:
                long = None
            if len(last["gram"]) > PAIRED:
                long = int(last["gram"][0])
                yield from _meetings(last, long, percent)
                last = {k: v[:0] for k, v in last.items()}
            held = last
        yield from _meetings(held, long, percent)

    ordered = columns.repartition("gram").sortWithinPartitions("gram", "n", "cls")
    return ordered.mapInArrow(run, "gram long, a long, b long, n int")


def _meetings(rows: dict, long: int | None, percent: int) -> Iterator[pa.RecordBatch]:
    """``long``: a column whose first rows were written before."""
    gram = rows["gram"]
    if not len(gram):
        return
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    sizes = np.diff(np.append(starts, len(gram)))
    many = np.repeat((sizes > PAIRED) | (gram[starts] == (gram[0] - 1 if long is None else long)), sizes)
    yield pa.RecordBatch.from_arrays(
        [pa.array(gram[many]), pa.array(rows["cls"][many]), pa.nulls(int(many.sum()), pa.int64()),
         pa.array(rows["n"][many].astype(np.int32))], names=["gram", "a", "b", "n"],
    )
    for step in range(1, PAIRED):  # pairs of neighbours at each distance
        x = np.flatnonzero((gram[:-step] == gram[step:]) & ~many[:-step])
        y = x + step
        nx, ny, px, py = rows["n"][x], rows["n"][y], rows["place"][x], rows["place"][y]
        most = np.minimum(px, py) + 1 + np.minimum(nx - px, ny - py) - 1
        fits = (100 * nx >= percent * ny) & (most >= least_overlap(nx, ny, percent))
        a, b = rows["cls"][x[fits]], rows["cls"][y[fits]]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(a), pa.int64()), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
             pa.nulls(len(a), pa.int32())], names=["gram", "a", "b", "n"],
        )


def _near_pairs(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny = (np.asarray(batch.column(k)) for k in ("nx", "ny"))
            most = nx + ny - 2 * least_overlap(nx, ny, percent)
            good = np.zeros(len(batch), bool)
            for k, (x, y) in enumerate(
                zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            ):
                size = min(len(x), len(y))
                u, v = (folded(np.frombuffer(z, np.uint8), size) for z in (x, y))
                good[k] = np.bitwise_count(u ^ v).sum() <= most[k]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    one = bitmaps.select(F.col("cls").alias("a"), F.col("n").alias("nx"), F.col("bits").alias("x"))
    other = bitmaps.select(F.col("cls").alias("b"), F.col("n").alias("ny"), F.col("bits").alias("y"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "nx", "x", "ny", "y").mapInArrow(
        run, "a long, b long"
    )


def _near_in_tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Edges between classes of each unit whose bitmaps allow a link; ``rows``: unit, side, cls, n, bits."""

    def multiply(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cls, n, side, unit = (table.column(k).to_numpy() for k in ("cls", "n", "side", "unit"))
        bits = table.column("bits").to_pylist()
        widths = np.array([len(x) for x in bits], np.int64)
        found = [(cls[:0], cls[:0])]
        for u in np.unique(unit):
            here = np.flatnonzero(unit == u)
            here = here[np.argsort(n[here], kind="stable")]
            crossed = side[here].any()
            for width in np.unique(widths[here]):
                # a partner of less than twice the size has bits as many, or twice as many
                rows = here[(widths[here] == width) | (widths[here] == 2 * width)]
                m = np.stack([folded(np.frombuffer(bits[r], np.uint8), width).view(np.uint64) for r in rows])
                own = widths[rows] == width
                reach = np.searchsorted(n[rows], n[rows] * 100 // percent, "right")
                for i in np.flatnonzero(own):
                    j = slice(i + 1, reach[i])
                    if j.start >= j.stop:
                        continue
                    ny = n[rows[j]]
                    most = n[rows[i]] + ny - 2 * least_overlap(n[rows[i]], ny, percent)
                    good = np.bitwise_count(m[j] ^ m[i]).sum(axis=1) <= most
                    if crossed:
                        good &= side[rows[j]] != side[rows[i]]
                    b = cls[rows[j][good]]
                    found.append((np.full(len(b), cls[rows[i]]), b))
                    if len(found) > 2000:
                        found = [local_roots(*(np.concatenate(p) for p in zip(*found, strict=True)))]
        a, b = local_roots(*(np.concatenate(p) for p in zip(*found, strict=True)))
        if len(a):
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    ordered = rows.repartition("unit").sortWithinPartitions("unit")
    return ordered.mapInArrow(_by_unit(multiply), "a long, b long")


def _blocks(docs: DataFrame, survey: DataFrame, ranks, n: int, percent: int) -> DataFrame:
    """(cls, root, n): the classes that may have links, by block."""
    met = written(_meet(_columns(docs, ranks, n, percent), percent), "jaccard-meetings")
    pairs = met.where("gram is null").select("a", "b").where("a <> b").distinct()
    members = met.where("gram is not null").select(
        F.col("gram").alias("root"), F.col("a").alias("cls"), "n"
    ).distinct()
    bitmaps = survey.groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    tiles = _tiles(members, percent).join(bitmaps, "cls").select("unit", "side", "cls", "n", "bits")
    edges = _near_pairs(pairs, bitmaps, percent).unionByName(_near_in_tiles(tiles, percent))
    tied = components(edges, "jaccard-blocks")
    found = tied.select(F.col("node").alias("cls"), "root").unionByName(
        tied.select(F.col("root").alias("cls"), "root").distinct()
    )
    sizes = survey.groupBy("cls").agg(F.first("n").alias("n"))
    return written(found.join(sizes, "cls"), "jaccard-members")


# ---------------------------------------------------------------- the product within blocks


def product_links(
    unit: np.ndarray, side: np.ndarray, sizes: np.ndarray, grams: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among rows of the same unit.

    Rows of side 0 and 1 are compared with each other only; in a unit of side 0 alone, all are.
    ``grams`` are the sets one after another.
    """
    order = np.lexsort((sizes, unit))
    begins = (np.cumsum(sizes) - sizes)[order]
    unit, side, n = unit[order], side[order], sizes[order]
    from_, to = np.searchsorted(unit, unit), np.searchsorted(unit, unit, "right")
    two_sided = np.maximum.reduceat(side, np.unique(from_))[np.unique(unit, return_inverse=True)[1]] > 0

    row = np.repeat(np.arange(len(n)), n)
    entry = np.concatenate([grams[b : b + k] for b, k in zip(begins, n, strict=True)])
    keys = mix(entry + mix(unit[row].astype(np.uint64) + np.uint64(1)))
    _, column, often = np.unique(keys, return_inverse=True, return_counts=True)
    shared = often[column] > 1  # columns of one row add to no overlap
    row, column = row[shared], column[shared]
    by_column = np.argsort(column, kind="stable")
    members = row[by_column]
    sorted_columns = column[by_column]
    # where in its column each entry stands, so that only later rows are counted
    after = np.empty(len(row), np.int64)
    after[by_column] = np.arange(1, len(row) + 1)
    end = np.searchsorted(sorted_columns, column, "right")
    row_at = np.searchsorted(row, np.arange(len(n) + 1))

    label = np.arange(len(n))
    a, b = [], []
    for i in range(len(n)):
        entries = slice(row_at[i], row_at[i + 1])
        counts = end[entries] - after[entries]
        total = int(counts.sum())
        if not total:
            continue
        stops = np.cumsum(counts)
        at = np.arange(total) + np.repeat(after[entries] - (stops - counts), counts)
        overlap = np.bincount(members[at] - i, minlength=1)
        j = np.flatnonzero(overlap)
        inter, j = overlap[j], j + i
        good = (100 * n[i] >= percent * n[j]) & (100 * inter >= percent * (n[i] + n[j] - inter))
        if two_sided[i]:
            good &= side[j] != side[i]
        for other in np.unique(label[j[good]]):
            if other != label[i]:
                a.append(i)
                b.append(int(j[good][label[j[good]] == other][0]))
                span = slice(from_[i], to[i])
                label[span][label[span] == other] = label[i]
    return order[np.array(a, np.int64)], order[np.array(b, np.int64)]


def _by_unit(multiply, at_once: int = 2 * TILE):
    """Rows in order of their unit, some whole units at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < at_once:
                continue
            table = pa.Table.from_batches(held)
            unit = table.column("unit").to_numpy()
            cut = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on
            if cut:
                yield from multiply(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from multiply(pa.Table.from_batches(held))

    return run


def _links(rows: DataFrame, percent: int) -> DataFrame:
    """Edges between linked classes of each unit; ``rows``: unit, side, cls, grams."""

    def multiply(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(table):
            return
        lists = table.column("grams").combine_chunks()
        cls = table.column("cls").to_numpy()
        a, b = product_links(
            table.column("unit").to_numpy(), table.column("side").to_numpy(),
            np.asarray(lists.value_lengths()).astype(np.int64),
            np.asarray(lists.flatten()).view(np.uint64), percent,
        )
        if len(a):
            yield pa.RecordBatch.from_pydict({"a": cls[a], "b": cls[b]})

    ordered = rows.repartition("unit").sortWithinPartitions("unit")
    return ordered.mapInArrow(_by_unit(multiply), "a long, b long").where("a <> b")


def _tiles(blocks: DataFrame, percent: int) -> DataFrame:
    """(cls, unit, side) of the tile products that each class takes part in; ``blocks``: cls, root, n."""
    # sizes within the bound lie in one bucket or in neighbours
    width = math.log(100 / percent) * (1 + 1e-9)
    bucket = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")
    sized = blocks.withColumn("bucket", bucket)
    small = blocks.groupBy("root").agg(F.count("*").alias("rows"))
    cuts = sized.groupBy("root", "bucket").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("cuts"))
    near = cuts.alias("x").join(cuts.alias("y"), F.expr(
        "x.root = y.root and y.bucket between x.bucket - 1 and x.bucket + 1"
    )).groupBy("x.root", "x.bucket").agg(
        F.max("x.cuts").alias("cuts"),
        F.max(F.expr("if(y.bucket = x.bucket - 1, y.cuts, 0)")).alias("below"),
        F.max(F.expr("if(y.bucket = x.bucket + 1, y.cuts, 0)")).alias("above"),
    )
    large = small.where(F.col("rows") > TILE).select("root")
    whole = blocks.join(large, "root", "left_anti").select(
        "cls", F.xxhash64("root").alias("unit"), F.lit(0).alias("side")
    )
    own = F.pmod(F.xxhash64("cls"), F.col("cuts")).cast("int")
    cut = sized.join(large, "root", "left_semi").join(near, ["root", "bucket"]).withColumn("own", own)
    pairs = F.expr("""
        concat(
          transform(sequence(0, cuts - 1), j -> named_struct('b', bucket, 'i', least(own, j), 'c', bucket,
                    'j', greatest(own, j), 'side', if(own > j, 1, 0))),
          if(below > 0, transform(sequence(0, below - 1), j -> named_struct('b', bucket - 1, 'i', j,
                    'c', bucket, 'j', own, 'side', 1)), array()),
          if(above > 0, transform(sequence(0, above - 1), j -> named_struct('b', bucket, 'i', own,
                    'c', bucket + 1, 'j', j, 'side', 0)), array()))
    """)
    tiled = cut.select("cls", "root", F.explode(pairs).alias("p")).select(
        "cls", F.xxhash64("root", "p.b", "p.i", "p.c", "p.j").alias("unit"), F.col("p.side").alias("side")
    )
    return whole.unionByName(tiled)


def _with_sets(docs: DataFrame, survey: DataFrame, tiles: DataFrame, n: int) -> DataFrame:
    """``tiles`` (cls, unit, side) with the sets of n-grams, from one document of each class.

    The units a class takes part in travel with its document's key, so a set is made once and
    shuffled once.
    """
    units = tiles.groupBy("cls").agg(F.collect_list(F.struct("unit", "side")).alias("units"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    picks = survey.join(units, "cls").groupBy("cls").agg(
        F.min_by("doc_id", first).alias("pick_id"), F.min_by("text_key", first).alias("pick_key"),
        F.first("units").alias("units"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("cls").to_pylist()
            units = batch.column("units")
            for begin, sets in _sets(batch, n):
                # a text key may have met another text
                good = [k for k, grams in enumerate(sets) if class_of(grams) == wanted[begin + k]]
                if good:
                    rows = pa.array([begin + k for k in good])
                    yield pa.RecordBatch.from_pydict({
                        "cls": batch.column("cls").take(rows), "units": units.take(rows),
                        "grams": pa.array([sets[k].view(np.int64) for k in good], pa.list_(pa.int64())),
                    })

    texts = _texts(docs)
    same = (texts.text_key == picks.pick_key) & texts.doc_id.eqNullSafe(picks.pick_id)
    chosen = texts.join(picks, same).select("cls", "units", "text")
    sets = chosen.mapInArrow(run, "cls long, units array<struct<unit:long,side:int>>, grams array<long>")
    # repeated rows give a class more than once; that changes no result
    return sets.select("cls", "grams", F.explode("units").alias("u")).select(
        F.col("u.unit").alias("unit"), F.col("u.side").alias("side"), "cls", "grams"
    )


def jaccard_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, text_key, n_shingles, cls and root, the class that names its component."""
    spark = docs.sparkSession
    surveyed = written(_survey(docs, n), "jaccard-survey")
    survey = surveyed.where("slice is null").select("doc_id", "text_key", "cls", "n", "bits")
    ranks = spark.sparkContext.broadcast(_column_ranks(surveyed))  # of fixed size
    tiles = _tiles(_blocks(docs, survey, ranks, n, percent), percent)
    rows = _with_sets(docs, survey, tiles, n)
    linked = components(_links(rows, percent), "jaccard-links")
    roots = linked.select(F.col("node").alias("cls"), "root")
    return survey.join(roots, "cls", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), "cls",
        F.coalesce("root", "cls").alias("root"),
    )


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    classes = jaccard_classes(docs, n, percent)
    groups = classes.where("n_shingles > 0").groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("rows")
    ).where("rows > 1").select("root", "component_id")
    return classes.join(groups, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id"))
        .otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id.

    Documents without n-grams all stay. Of repeated rows one stays.
    """
    classes = jaccard_classes(docs, n, percent).where("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    chosen = classes.groupBy("root").agg(F.min(first).alias("first"), F.count("*").alias("rows"))
    rows = classes.groupBy("root").agg(F.min(first).alias("f")).select("root", "f")
    repeated = classes.join(rows, "root").where(
        F.col("f.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("f.text_key") == F.col("text_key"))
    ).groupBy("root").agg(F.count("*").alias("equal"))
    kept = chosen.join(repeated, "root").select(
        F.col("first.doc_id").alias("__kept_id"), F.col("first.text_key").alias("__kept_key"), "equal"
    )
    kept = written(kept, "jaccard-kept")
    keyed = docs.withColumn("__key", text_key())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__kept_id")) & (F.col("__key") == F.col("__kept_key"))
    wordless = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    single = keyed.join(kept.where("equal = 1"), same, "left_semi")
    several = keyed.join(kept.where("equal > 1"), same, "left_semi").dropDuplicates(["doc_id", "__key"])
    return single.unionByName(several).unionByName(keyed.where(wordless)).select(*docs.columns)

"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows stay where they were read while it is drawn how many of each input partition go to each shard:
rows of the matrix add up to the partitions' sizes, columns to the shards' sizes, and each entry has
the distribution that a uniform permutation of all rows would give. Then each partition permutes its
rows and deals them out by its line of the matrix, and each shard permutes what it got. Shard sizes
are exact (at most one apart) and no row or key can make a shard large.

Only the matrix passes the driver: a line of shard counts per input partition. All else is DataFrame
functions. Nulls, repeated rows and equal texts are rows like any other; an empty table gives no
rows; other columns are carried along, and the columns added replace ones of the same name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.folders import written

#: Rows that one task sorts in the second permutation, about.
BUCKET = 200_000


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Counts by partition and shard, as a uniform permutation would deal them."""
    random, left = np.random.default_rng(seed), np.array(shards, np.int64)
    out = np.zeros((len(rows), len(shards)), np.int64)
    for k, size in enumerate(rows):
        need, rest = size, int(left.sum())
        for j in range(len(shards)):  # a draw per cell, given the ones before it
            rest -= int(left[j])
            good, bad = int(left[j]), rest
            take = need if bad == 0 else _hypergeometric(random, good, bad, need)
            out[k, j] = take
            left[j] -= take
            need -= take
    return out


def _hypergeometric(random: np.random.Generator, good: int, bad: int, draws: int) -> int:
    if draws == 0 or good == 0:
        return 0
    if max(good, bad) < 10**9:
        return int(random.hypergeometric(good, bad, draws))
    return _inverted(random, good, bad, draws)


def _inverted(random: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """A hypergeometric draw of any size: inversion over forty deviations around the mode, with
    probabilities from the ratios of neighbours, so that no large factorials cancel."""
    mode = (draws + 1) * (good + 1) // (good + bad + 2)
    spread = np.sqrt(draws * (good / (good + bad)) * (bad / (good + bad)) * (1 - draws / (good + bad + 1)))
    reach = 40 + int(40 * spread)
    k = np.arange(max(0, draws - bad, mode - reach), min(good, draws, mode + reach) + 1)
    here = k[:-1]
    ratios = np.log(good - here) + np.log(draws - here) - np.log(here + 1) - np.log(bad - draws + here + 1)
    weights = np.concatenate([[0.0], np.cumsum(ratios)])
    upto = np.cumsum(np.exp(weights - weights.max()))
    return int(k[np.searchsorted(upto, random.random() * upto[-1], side="right")])


def _random(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def shard_rows(df: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    # the input's partitions, fixed by writing the rows once with their place
    place = F.monotonically_increasing_id()
    source = written(
        df.withColumn("__place", place).withColumn("__part", F.shiftright("__place", 33)), "shard-rows"
    )
    sizes = {r["__part"]: r["count"] for r in source.groupBy("__part").count().collect()}
    parts = sorted(sizes)
    total = sum(sizes.values())
    targets = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([sizes[p] for p in parts], targets, seed)
    lines = spark.createDataFrame(
        [(p, bounds) for p, bounds in zip(parts, np.cumsum(matrix, axis=1).tolist(), strict=True)],
        "__part long, __bounds array<long>",
    )

    # first permutation, within each input partition; its line of the matrix deals it out
    local = F.row_number().over(Window.partitionBy("__part").orderBy(_random(seed, "__place"), "__place"))
    dealt = source.withColumn("__local", local.cast("long")).join(lines, "__part")
    shard = F.size(F.filter("__bounds", lambda b: b < F.col("__local")))
    dealt = dealt.withColumn("shard", shard)

    # second permutation, within each shard, in buckets that a task can sort
    buckets = max(1, -(-max([0, *targets]) // BUCKET))
    bucket = F.pmod(_random(seed + 1, "__place"), F.lit(buckets)).cast("int")
    dealt = dealt.withColumn("__bucket", bucket)
    counted = dealt.groupBy("shard", "__bucket").count()
    before = Window.partitionBy("shard").orderBy("__bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select(
        "shard", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base")
    )
    inner = Window.partitionBy("shard", "__bucket").orderBy(_random(seed + 2, "__place"), "__place")
    slot = F.col("__base") + F.row_number().over(inner) - 1
    placed = dealt.join(base, ["shard", "__bucket"]).withColumn("slot", slot)
    return placed.select(*df.columns, "shard", "slot")

"""Exact quantiles per group without collecting a group.

Spark's exact percentile keeps all values of a group in one task. Here the approximate percentile
(partial sketches per task) gives a narrow bracket around every wanted quantile, the values below,
inside and between the brackets are counted, and only the pieces that hold a wanted position are
ordered. Equal values are merged beforehand, so a value with very many copies stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.joins import null_safe_join


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    margin: float = 0.002,
    accuracy: int = 10_000,
) -> DataFrame:
    """Linear-interpolated quantiles of the non-NULL values of every group, one column each.

    Results are exact for every ``margin``. It only sets how much of a group is ordered: a bracket
    holds about ``2 * margin`` of the group's rows.
    """
    v, copies = F.col(value), F.col("__copies")
    keys = list(keys)
    present = df.where(v.isNotNull())
    counted = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__copies"))

    steps = sorted(
        {min(1.0, max(0.0, q + side * margin)) for q in quantiles.values() for side in (-1, 1)}
    )
    edges = present.groupBy(*keys).agg(
        F.percentile_approx(v, F.array(*map(F.lit, steps)), accuracy).alias("__edges")
    )
    # no hint: the side is broadcast if Spark measures it as small, else a skewed join is split
    piece = reduce(
        lambda a, b: a + b,
        (F.when(F.col("__edges")[i] <= v, 1).otherwise(0) for i in range(len(steps))),
    )
    placed = null_safe_join(counted, edges, keys).select(
        *keys, value, "__copies", piece.alias("__piece")
    )

    # positions covered by every piece of a group: a handful of rows per group
    in_order, whole = Window.partitionBy(*keys).orderBy("__piece"), Window.partitionBy(*keys)
    size = F.col("__size")
    spans = (
        placed.groupBy(*keys, "__piece").agg(F.sum(copies).alias("__size"))
        .select(
            *keys, "__piece",
            (F.sum(size).over(in_order) - size).alias("__before"),
            F.sum(size).over(in_order).alias("__upto"),
            F.sum(size).over(whole).alias("__n"),
        )
    )
    wanted = [F.lit(float(q)) * (F.col("__n") - 1) for q in quantiles.values()]
    positions = F.array(*(p for w in wanted for p in (F.floor(w), F.ceil(w))))
    needed = spans.where(
        F.exists(positions, lambda p: (p >= F.col("__before")) & (p < F.col("__upto")))
    )

    inside = Window.partitionBy(*keys, "__piece").orderBy(value)
    end = F.col("__before") + F.sum(copies).over(inside)
    ranked = null_safe_join(placed, needed, [*keys, "__piece"]).select(
        *keys, value, "__n", (end - copies).alias("__from"), end.alias("__to")
    )

    def at(position):
        return F.max(F.when((position >= F.col("__from")) & (position < F.col("__to")), v))

    columns = []
    for name, w in zip(quantiles, wanted, strict=True):
        low, high = at(F.floor(w)), at(F.ceil(w))
        columns.append((low + (high - low) * F.max(w - F.floor(w))).alias(name))
    return ranked.groupBy(*keys).agg(*columns)

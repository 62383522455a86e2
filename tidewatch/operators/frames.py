"""Keeping window groups small for trailing frames, with unchanged results.

A window group is sorted and evaluated by one task. Two things can make one large:

* a long series: it is cut at calendar boundaries, and each chunk gets a copy of the few rows that
  precede it (``with_carried_rows``), so that a trailing frame sees the same rows as before;
* very many copies of one row: once a frame is filled with copies, every further copy has the same,
  known result, so only the first few need to be in the window (``split_copies``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.joins import null_safe_join

CHUNK = "__chunk"
CARRIED = "__carried"
REPEAT_BLOCK = 100_000
PIECES = 128


def with_carried_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    chunk: str,
    reach: int,
    chunk_rows: int | None = None,
) -> tuple[DataFrame, str]:
    """Add a chunk column, and to every chunk the ``reach`` rows of the series just before it.

    Rows are in the order of (``order``, ``tie``). Returns the frame and the name of the chunk column;
    ``drop_carried`` removes the copies again. Only the last ``reach`` rows of every chunk are needed
    to find the copies: Spark keeps no more than those per task before it shuffles (a rank filter on
    a window). With ``chunk_rows``, single values of ``order`` with more rows than that are cut
    further, see ``_cut``.
    """
    columns = df.columns
    cut = _cut(df, keys, order, tie, chunk, chunk_rows)

    latest_first = Window.partitionBy(*keys, CHUNK).orderBy(F.desc(order), F.desc(tie))
    tails = cut.withColumn("__back", F.row_number().over(latest_first)).where(
        F.col("__back") <= reach
    )

    along = Window.partitionBy(*keys).orderBy(order, tie)
    carried = (
        tails.withColumns(
            {
                "__previous": F.lag(CHUNK).over(along),
                "__before": F.collect_list(F.struct(*columns)).over(along.rowsBetween(-reach, -1)),
            }
        )
        # the first kept row of a chunk is preceded by exactly the rows the chunk needs
        .where(F.col("__previous") != F.col(CHUNK))
        .select(CHUNK, F.explode("__before").alias("__row"))
        .select("__row.*", CHUNK, F.lit(True).alias(CARRIED))
    )
    return cut.withColumn(CARRIED, F.lit(False)).unionByName(carried), CHUNK


def _cut(
    df: DataFrame, keys: Sequence[str], order: str, tie: str, chunk: str, chunk_rows: int | None
) -> DataFrame:
    """Number the chunks of every series so that the number never falls along the series.

    The first part of the number is the calendar chunk. With ``chunk_rows``, an ``order`` value (a
    date) with more rows is cut at approximate quantiles of ``tie``: the second part tells the
    stretches before, at and after such values apart, the third counts the quantiles passed.
    """
    period = F.date_trunc(chunk, F.col(order).cast("timestamp_ntz"))
    if chunk_rows is None:
        return df.withColumn(CHUNK, F.struct(period.alias("period")))

    steps = F.array(*(F.lit(i / PIECES) for i in range(1, PIECES)))
    busy = (
        df.groupBy(*keys, order)
        .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(tie, steps).alias("edges"))
        .where(F.col("n") > chunk_rows)
        .groupBy(*keys, period.alias("__period"))
        .agg(F.collect_list(F.struct(F.col(order).alias("at"), "edges")).alias("__busy"))
    )
    here = F.filter("__busy", lambda b: b["at"] == F.col(order))
    passed = F.size(F.filter("__busy", lambda b: b["at"] < F.col(order)))
    stretch = 2 * passed + F.size(here)
    piece = F.size(F.filter(here[0]["edges"], lambda edge: edge < F.col(tie)))
    placed = null_safe_join(
        df.withColumn("__period", period), busy, [*keys, "__period"], "left"
    )
    return placed.select(
        *df.columns,
        F.struct(
            F.col("__period").alias("period"),
            F.when(F.col("__busy").isNotNull(), stretch).otherwise(F.lit(0)).alias("stretch"),
            F.when(F.size(here) > 0, piece).otherwise(F.lit(0)).alias("piece"),
        ).alias(CHUNK),
    )


def drop_carried(df: DataFrame) -> DataFrame:
    return df.where(~F.col(CARRIED)).drop(CHUNK, CARRIED)


def split_copies(df: DataFrame, reach: int) -> tuple[DataFrame, DataFrame]:
    """Split the rows into the first ``reach`` copies of every row and the further copies.

    Rows are copies if they are equal in all columns. They are counted per task before the shuffle. A
    frame of ``reach`` rows before a further copy holds copies only, so its result is known without
    a window. Many further copies of one row are written out by many tasks.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    copies = F.col("__copies")
    first = counted.withColumn("__copies", F.least(copies, F.lit(reach)))
    further = (
        counted.where(copies > reach)
        .withColumn("__copies", copies - reach)
        .withColumn(
            "__block",
            F.explode(
                F.sequence(
                    F.lit(0).cast("long"), F.floor((copies - 1) / REPEAT_BLOCK).cast("long")
                )
            ),
        )
        .repartition("__block", *df.columns)
        .withColumn("__copies", F.least(F.lit(REPEAT_BLOCK), copies - F.col("__block") * REPEAT_BLOCK))
        .drop("__block")
    )
    return _repeat(first), _repeat(further)


def _repeat(df: DataFrame) -> DataFrame:
    numbers = F.sequence(F.lit(1).cast("long"), F.col("__copies").cast("long"))
    return df.withColumn("__copy", F.explode(numbers)).drop("__copy", "__copies")

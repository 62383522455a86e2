"""The drift tables by batches of new dates, each from its own rows and a short tail of every series.

A row's statistics reach back over the rows of its frame, an alert's context over the alerts before
it. So a batch needs the last rows and alerts of each series, and how many alerts there were; these
tails are kept with each batch. Results equal those of a full rebuild.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions.joins import null_safe_join
from tidewatch.operators.drift import ALERT_COLUMNS, classify_drift, drift_alerts
from tidewatch.operators.insights import Complete, explain_alerts
from tidewatch.operators.rolling import SERIES, rolling_stats, stage_metrics
from tidewatch.sources.tables import overwrite_table, read_table

STORED = ("drift", "alerts", "insights")
# rows before its own that a frame of rolling statistics takes in
FRAME = 13
NEW = "__new"
SO_FAR = "__alerts"


class LateRows(ValueError):
    """Rows of dates that a series has passed: they change frames that are stored already."""


def _last_committed(spark: SparkSession, folder: str, before: int | None = None) -> int | None:
    try:
        commits = spark.read.schema("batch long").parquet(f"{folder}/commits/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        commits = commits.where(F.col("batch") < before)
    return commits.agg(F.max("batch")).first()[0]


def _last(df: DataFrame, rows: int) -> DataFrame:
    """The last ``rows`` rows of each series, in the order that frames take them."""
    place = F.row_number().over(
        Window.partitionBy(*SERIES).orderBy(F.desc("metric_date"), F.desc("metric_value"))
    )
    return df.withColumn("__place", place).where(F.col("__place") <= rows).drop("__place")


def append_drift_tables(
    raw: DataFrame,
    folder: str,
    batch: int,
    complete: Complete | None = None,
    context: str = "trailing",
    context_rows: int = 3,
) -> None:
    """Add the rows of ``raw``, all of dates after those of their series so far, to the tables in ``folder``.

    Reads ``raw`` and the tails of the batch before, nothing else. Batches are numbered upwards, and
    readers see one when it is complete. A batch that ended early is written again under its number;
    so can be the last complete one, in place. Rows that come late raise ``LateRows`` and change
    nothing: rebuild the tables then, or write the last batch again with them.
    """
    spark = raw.sparkSession
    newest = _last_committed(spark, folder)
    if newest is not None and newest > batch:
        raise ValueError(f"batch {newest} is there already; only the last batch can be replaced")
    before = _last_committed(spark, folder, batch)
    staged = stage_metrics(raw)
    if before is None:
        tail = staged.limit(0)
    else:
        tail = read_table(spark, f"{folder}/tails/batch-{before}")
        ends = tail.groupBy(*SERIES).agg(F.max("metric_date").alias("end"))
        starts = staged.groupBy(*SERIES).agg(F.min("metric_date").alias("start"))
        late = null_safe_join(starts, ends, SERIES).where("start <= end").count()
        if late:
            raise LateRows(f"{late} series have rows of dates that batch {before} has passed")

    rows = tail.withColumn(NEW, F.lit(False)).unionByName(staged.withColumn(NEW, F.lit(True)))
    overwrite_table(classify_drift(rolling_stats(rows).where(NEW)), f"{folder}/drift/batch={batch}")
    overwrite_table(_last(rows.drop(NEW), FRAME), f"{folder}/tails/batch-{batch}")

    found = read_table(spark, f"{folder}/drift/batch={batch}").where("is_drift_alert")
    found = found.withColumns({NEW: F.lit(True), SO_FAR: F.lit(0).cast("long")})
    known = found.limit(0) if before is None else read_table(spark, f"{folder}/alert-tails/batch-{before}")
    both = known.unionByName(found)
    alerts = drift_alerts(both, context=context, context_rows=context_rows, keep=[NEW]).where(NEW).drop(NEW)
    if context == "running":  # the rows of the tail were numbered as well
        earlier = known.groupBy(*SERIES).agg((F.max(SO_FAR) - F.count(F.lit(1))).alias("__earlier"))
        number = F.col("consecutive_alert_window") + F.coalesce("__earlier", F.lit(0))
        alerts = null_safe_join(alerts, earlier, SERIES, "left").withColumn(
            "consecutive_alert_window", number
        ).drop("__earlier")
    overwrite_table(alerts.select(*ALERT_COLUMNS), f"{folder}/alerts/batch={batch}")
    series = Window.partitionBy(*SERIES)
    so_far = F.max(SO_FAR).over(series) + F.count_if(F.col(NEW)).over(series)
    ended = _last(both.withColumn(SO_FAR, so_far), max(1, context_rows - 1))
    overwrite_table(ended.withColumn(NEW, F.lit(False)), f"{folder}/alert-tails/batch-{batch}")

    alerts = read_table(spark, f"{folder}/alerts/batch={batch}")
    overwrite_table(explain_alerts(alerts, complete), f"{folder}/insights/batch={batch}")
    done = spark.createDataFrame([(batch,)], "batch long").coalesce(1)
    overwrite_table(done, f"{folder}/commits/batch-{batch}")


def read_appended(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables drift, alerts and insights, up to the last complete batch."""
    last = _last_committed(spark, folder)
    if name not in STORED or last is None:
        raise ValueError(f"no table {name!r} in {folder}")
    return read_table(spark, f"{folder}/{name}").where(F.col("batch") <= last).drop("batch")

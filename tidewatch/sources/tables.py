"""Reading and writing metric tables and the measurement history."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.sources.schemas import MEASUREMENTS, RAW_METRICS


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw metric observations from CSV with a header; the schema is given, never inferred."""
    return spark.read.schema(RAW_METRICS).option("header", True).csv(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Rebuild a table in full."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# The identity of a batch: what writing it again replaces.
PARTITIONS = ["measured_date", "measured_table", "monitor", "batch_id"]
NAMES = ["table_database", "table_schema", "table_name"]


def _table_key() -> Column:
    return F.concat_ws(".", *(F.coalesce(F.col(n), F.lit("")) for n in NAMES))


def append_measurements(
    measurements: DataFrame, path: str, batch_id: int | None = None, monitor: str = "default"
) -> None:
    """Append measurements to a history that is partitioned by day, table, monitor and batch.

    With a ``batch_id``, writing the same batch of the same monitor and table again replaces it, and
    nothing else. ``measured_date`` is the day on which the batch was first measured: it stays when
    the batch is repeated after midnight.
    """
    spark = measurements.sparkSession
    day = F.to_date("measurement_time")
    if batch_id is not None:
        # days of earlier attempts, from partition values: one per table of this batch
        earlier = (
            read_measurements(spark, path)
            .where((F.col("monitor") == monitor) & (F.col("batch_id") == batch_id))
            .groupBy("measured_table").agg(F.min("measured_date").alias("day")).collect()
        )
        day = F.min(day).over(Window.partitionBy("measured_table"))
        for row in earlier:
            day = F.when(F.col("measured_table") == row["measured_table"], F.lit(row["day"])).otherwise(day)
    dated = (
        measurements.withColumn("measured_table", _table_key()).withColumn("measured_date", day)
        .withColumn("monitor", F.lit(monitor))
        .withColumn("batch_id", F.lit(-1 if batch_id is None else batch_id).cast("long"))
        .repartition("measured_date", "measured_table")  # a file per partition, not one per task
    )
    writer = dated.write.partitionBy(*PARTITIONS)
    if batch_id is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_measurements(
    spark: SparkSession,
    path: str,
    table: str | None = None,
    schema: str | None = None,
    database: str | None = None,
    dates: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """The history, of one table if given; empty with the right schema before the first measurement.

    ``table``, ``schema`` and ``database`` name a table in full, so far as they are given; ``dates``
    (first and last ``measured_date``) reads only the partitions of these days.
    """
    stored = T.StructType(
        MEASUREMENTS.fields
        + [
            T.StructField("measured_date", T.DateType()),
            T.StructField("measured_table", T.StringType()),
            T.StructField("monitor", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    try:
        history = spark.read.schema(stored).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        history = spark.createDataFrame([], stored)
    for name, value in zip(NAMES, (database, schema, table), strict=True):
        if value is not None:
            history = history.where(F.col(name) == value)
    if None not in (database, schema, table):
        history = history.where(F.col("measured_table") == f"{database}.{schema}.{table}")
    if dates is not None:
        history = history.where(F.col("measured_date").between(*dates))
    return history

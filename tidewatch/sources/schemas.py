"""Table schemas."""

from pyspark.sql import types as T

RAW_METRICS = T.StructType(
    [
        T.StructField("metric_date", T.DateType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("segment", T.StringType()),
    ]
)

# One row per measurement, as the checks write it.
MEASUREMENTS = T.StructType(
    [
        T.StructField("measurement_time", T.TimestampNTZType()),
        T.StructField("table_database", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("metric_database", T.StringType()),
        T.StructField("metric_schema", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("columns", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# One row per measurement with its verdict.
QUALITY_LOG = T.StructType(
    [
        T.StructField("measured_at", T.TimestampNTZType()),
        T.StructField("db_name", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("dmf_name", T.StringType()),
        T.StructField("dmf_value", T.DoubleType()),
        T.StructField("quality_status", T.StringType()),
        T.StructField("quality_note", T.StringType()),
        T.StructField("columns", T.StringType()),
    ]
)

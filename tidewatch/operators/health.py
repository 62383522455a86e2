"""Health score of the checked tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.quality import latest_status, status_rank

# fixed values: points lost per check by status, factor by check type
DEDUCTIONS = {"fail": 8.0, "warn": 2.0, "pass": 0.0}
MULTIPLIERS = {"system": 1.5, "custom": 1.0}

# fixed values: smallest score of each grade and label, best first
GRADES = ((95, "A", "Healthy"), (85, "B", "Monitoring"), (70, "C", "At Risk"), (50, "D", "Degraded"))
LOWEST_GRADE = ("F", "Critical")
NO_DATA = "No Data"


def _from_map(key: Column, values: Mapping[str, float], default: float) -> Column:
    found = F.lit(default)
    for name, value in values.items():
        found = F.when(key == name, F.lit(value)).otherwise(found)
    return found


def _graded(score: Column, which: int) -> Column:
    text = F.lit(LOWEST_GRADE[which])
    for bound, *texts in reversed(GRADES):
        text = F.when(score >= bound, F.lit(texts[which])).otherwise(text)
    return text


def with_deductions(
    log: DataFrame,
    deductions: Mapping[str, float] = DEDUCTIONS,
    multipliers: Mapping[str, float] = MULTIPLIERS,
) -> DataFrame:
    """Add the points lost per row. A log without check types counts as custom throughout."""
    if "check_type" not in log.columns:
        log = log.withColumn("check_type", F.lit("custom"))
    lost = _from_map(F.col("quality_status"), deductions, 0.0) * _from_map(
        F.col("check_type"), multipliers, 1.0
    )
    return log.withColumn("deduction", lost)


def health_breakdown(
    log: DataFrame,
    deductions: Mapping[str, float] = DEDUCTIONS,
    multipliers: Mapping[str, float] = MULTIPLIERS,
    keys: Sequence[str] = ("dmf_name", "table_name"),
) -> DataFrame:
    """Points lost per check in its latest state, worst status first."""
    return (
        with_deductions(latest_status(log, keys), deductions, multipliers)
        .select(
            "dmf_name", "table_name", "check_type", "quality_status", "dmf_value",
            "quality_note", "measured_at", "deduction",
        )
        .orderBy(status_rank(F.col("quality_status")), "dmf_name", "table_name")
    )


def _score_columns() -> list[Column]:
    lost = F.coalesce(F.sum("deduction"), F.lit(0.0))
    # half-even, as the score is defined
    score = F.greatest(F.lit(0), F.bround(F.lit(100) - lost).cast("int"))
    return [
        score.alias("score"),
        F.count(F.lit(1)).alias("total_checks"),
        *(
            F.count_if(F.col("quality_status") == status).alias(name)
            for status, name in (("pass", "passing"), ("warn", "warnings"), ("fail", "failures"))
        ),
        lost.alias("deduction"),
    ]


def health_score(
    log: DataFrame,
    deductions: Mapping[str, float] = DEDUCTIONS,
    multipliers: Mapping[str, float] = MULTIPLIERS,
    keys: Sequence[str] = ("dmf_name", "table_name"),
) -> DataFrame:
    """One row: score, grade, label and counts. An empty log scores 100 with the label "No Data"."""
    lost = with_deductions(latest_status(log, keys), deductions, multipliers)
    score = F.col("score")
    return lost.agg(*_score_columns()).select(
        "score",
        _graded(score, 0).alias("grade"),
        F.when(F.col("total_checks") == 0, NO_DATA).otherwise(_graded(score, 1))
        .alias("status_label"),
        "total_checks", "passing", "warnings", "failures", "deduction",
    )


def score_history(
    log: DataFrame,
    deductions: Mapping[str, float] = DEDUCTIONS,
    multipliers: Mapping[str, float] = MULTIPLIERS,
    keys: Sequence[str] = ("dmf_name", "table_name"),
) -> DataFrame:
    """The score of every day from that day's measurements alone, in one aggregation over all days."""
    day = F.to_date("measured_at").alias("date")
    daily = with_deductions(latest_status(log, keys, within=[day]), deductions, multipliers)
    return (
        daily.groupBy("date")
        .agg(*_score_columns())
        .select("date", "score", "failures", "warnings")
        .orderBy("date")
    )

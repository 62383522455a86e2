"""From measurements to a quality log: verdicts, notes, tags, filters, latest state, trends."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.numeric import wall_clock
from tidewatch.functions.text import num_text, short_name, sql_text, template_sql

ALL = "All"


@dataclass(frozen=True)
class Rule:
    """A verdict for the checks whose qualified name matches ``pattern`` (case-insensitive LIKE)."""

    pattern: str
    violated: str  # SQL predicate over the measured value ``v``
    status: str
    note: str | None = None  # slots: {value}, {table}

    def applies(self) -> str:
        violated = re.sub(r"\bv\b", "dmf_value", self.violated)
        return f"dmf_name ilike {sql_text(self.pattern)} and ({violated})"


# fixed values: verdict rules by check name, first match wins, with the text of the note
DEFAULT_RULES = (
    Rule("%null_count%", "v > 0", "fail", "{value} NULL(s) detected in {table}"),
    Rule("%duplicate_count%", "v > 0", "fail", "{value} duplicate row(s) in {table}"),
    Rule("%row_count%", "v = 0", "fail", "{table} has 0 rows — table appears empty"),
    Rule("%conversion_rate_valid%", "v > 0", "fail",
         "{value} conversion_rate value(s) outside [0, 1]"),
    Rule("%revenue_non_negative%", "v > 0", "fail", "{value} negative revenue row(s) detected"),
    Rule("%active_users_positive%", "v > 0", "fail",
         "{value} active_users row(s) with value <= 0"),
    Rule("%severity_valid%", "v > 0", "fail"),
    Rule("%zscore_plausible%", "v > 0", "fail"),
    Rule("%volume_anomaly%", "v = 1", "fail",
         "Latest date row count is statistically anomalous (>2σ from mean)"),
    Rule("%date_gaps%", "v > 0", "fail", "{value} date gap(s) > 1 day detected in {table}"),
    Rule("%cardinality%", "v != 3", "fail", "Expected 3 distinct metric names, found {value}"),
    Rule("%z_score_readiness%", "v > 0", "warn",
         "{value} row(s) have NULL z_score (< 7 days history)"),
    Rule("%mean_drift%", "v not between -2 and 2", "warn",
         "Mean drift z-score = {value} (|z| > 2)"),
)
NO_NOTE = "OK"

# The default set leaves two failing checks with the note "OK"; this one explains them as well.
EXPLAINED_RULES = tuple(
    replace(rule, note=note) if note else rule
    for rule, note in (
        (rule, {"%severity_valid%": "{value} row(s) with an unexpected severity in {table}",
                "%zscore_plausible%": "{value} row(s) with an implausible z-score in {table}"}
         .get(rule.pattern))
        for rule in DEFAULT_RULES
    )
)

# fixed values: names of system checks (case-insensitive LIKE)
SYSTEM_PATTERNS = (
    "%null_count%", "%duplicate_count%", "%row_count%", "%freshness%", "%.core.min%", "%.core.max%",
)

# fixed values: check kind -> (label, value) of the line that a measurement is compared with
THRESHOLDS = {
    "null_count": ("= 0 to pass", 0),
    "duplicate_count": ("= 0 to pass", 0),
    "row_count": ("> 0 to pass", 1),
    "conversion_rate_valid": ("= 0 to pass", 0),
    "revenue_non_negative": ("= 0 to pass", 0),
    "active_users_positive": ("= 0 to pass", 0),
    "volume_anomaly": ("= 0 to pass", 0),
    "date_gaps": ("= 0 to pass", 0),
    "cardinality_metric_name": ("= 3 to pass", 3),
    "severity_valid": ("= 0 to pass", 0),
    "zscore_plausible": ("= 0 to pass", 0),
    "z_score_readiness": ("= 0 to pass", 0),
}

STATUSES = ("fail", "warn", "pass")  # worst first


def status_rank(status: Column) -> Column:
    """0 for the worst status, rising; unknown names come last."""
    rank = F.lit(len(STATUSES))
    for position, name in enumerate(STATUSES):
        rank = F.when(status == name, F.lit(position)).otherwise(rank)
    return rank


def quality_log(*histories: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Unite measurement histories and give every measurement a status and a note.

    A NULL value violates no rule. Order the result with ``order_log`` where it is shown.
    """
    history = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), histories)
    named = history.select(
        F.col("measurement_time").cast("timestamp_ntz").alias("measured_at"),
        F.col("table_database").alias("db_name"),
        F.col("table_schema").alias("schema_name"),
        "table_name",
        F.concat("metric_database", F.lit("."), "metric_schema", F.lit("."), "metric_name")
        .alias("dmf_name"),
        F.col("value").cast("double").alias("dmf_value"),
        *(c for c in ("columns",) if c in history.columns),
    )
    slots = {"value": "__value_text", "table": "table_name"}
    status = _first_match([(r.applies(), sql_text(r.status)) for r in rules], "pass")
    note = _first_match(
        [(r.applies(), template_sql(r.note, slots)) for r in rules if r.note is not None], NO_NOTE
    )
    return (
        named.withColumn("__value_text", num_text(F.col("dmf_value")))
        .withColumns({"quality_status": F.expr(status), "quality_note": F.expr(note)})
        .drop("__value_text")
    )


def _first_match(cases: Sequence[tuple[str, str]], otherwise: str) -> str:
    if not cases:
        return sql_text(otherwise)
    whens = " ".join(f"when {condition} then {result}" for condition, result in cases)
    return f"case {whens} else {sql_text(otherwise)} end"


def order_log(log: DataFrame) -> DataFrame:
    """Worst status first, then newest first."""
    return log.orderBy(status_rank(F.col("quality_status")), F.desc("measured_at"))


def tag_check_type(log: DataFrame, patterns: Sequence[str] = SYSTEM_PATTERNS) -> DataFrame:
    """Add ``check_type``: system or custom, by the name of the check."""
    name = F.col("dmf_name")
    is_system = reduce(lambda a, b: a | b, (name.ilike(p) for p in patterns))
    return log.withColumn("check_type", F.when(is_system, "system").otherwise("custom"))


def in_date_range(column: str, dates: tuple[dt.date, dt.date] | None) -> Column:
    """Both days inclusive, as a plain range on the column so that it reaches the file scan."""
    if dates is None:
        return F.lit(True)
    start, end = dates
    begin = dt.datetime.combine(start, dt.time())
    stop = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
    c = F.col(column)
    return (c >= wall_clock(begin)) & (c < wall_clock(stop))


def filter_log(
    log: DataFrame,
    status: str | None = None,
    check_type: str | None = None,
    dates: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Keep the rows that match the given filters; None or "All" leaves a filter out.

    Apply before ``latest_status``: latest then means the latest row that matches.
    """
    for column, wanted in (("quality_status", status), ("check_type", check_type)):
        if wanted and wanted != ALL:
            log = log.where(F.col(column) == wanted.lower())
    if dates is not None:
        log = log.where(in_date_range("measured_at", dates))
    return log


def latest_status(
    log: DataFrame,
    keys: Sequence[str] = ("dmf_name", "table_name"),
    within: Sequence[str | Column] = (),
) -> DataFrame:
    """The newest row per check and table. Of rows with the same time the worst one counts.

    An aggregate, not a window: every task keeps one row per check before the shuffle. ``within``
    adds grouping columns (one result per group of them).
    """
    position = F.struct(
        F.col("measured_at"),
        -status_rank(F.col("quality_status")),
        F.col("dmf_value"),
        F.col("quality_note"),
        *(F.col(c) for c in ("columns",) if c in log.columns and c not in keys),
    )
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*within, *keys).agg(
        F.max_by(F.struct(*rest), position).alias("__row")
    )
    extra = [c for c in newest.columns if c not in (*keys, "__row")]
    return newest.select(*extra, *keys, "__row.*")


def order_status(latest: DataFrame) -> DataFrame:
    """Failing checks first, then by name."""
    return latest.orderBy(status_rank(F.col("quality_status")), "dmf_name", "table_name")


def check_value_trend(
    log: DataFrame,
    check: str,
    thresholds: dict[str, tuple[str, float]] = THRESHOLDS,
) -> DataFrame:
    """One check's values over time, with its comparison line (NULL for a check without one)."""
    label, line = thresholds.get(check.rsplit(".", 1)[-1].lower(), (None, None))
    return (
        log.where(F.col("dmf_name") == check)
        .select(
            "measured_at",
            "table_name",
            short_name(F.col("dmf_name")).alias("check_label"),
            "dmf_value",
            "quality_status",
            F.lit(label).cast("string").alias("threshold_label"),
            F.lit(line).cast("double").alias("threshold_value"),
        )
        .orderBy("measured_at")
    )

"""Explanation prompts and texts for alerts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.numeric import round_half_up
from tidewatch.functions.text import fill_template, num_text
from tidewatch.operators.answers import AnswerStore, Complete

# fixed value: the text of a prompt
PROMPT = (
    "You are an analytics engineer explaining metric anomalies to a business stakeholder. "
    "Be concise (2-3 sentences). Metric: {metric}. Date: {date}. Value: {value}. "
    "14-day average: {average}. Z-score: {z}. Direction: {direction}. Severity: {severity}. "
    "Deviation from average: {deviation}%. Weekend: {weekend}. Day-over-day change: {change}. "
    "Explain what happened and suggest a possible cause."
)

# What the built-in explanation says, by severity and direction.
ADVICE = {
    "critical": "Check the upstream load and tracking for this date before reading it as behaviour",
    "warning": "Compare with known campaigns, releases and other segments of the metric",
    "watch": "Keep an eye on the next observations; no action is needed yet",
}
MOVEMENT = {"above": "rose above", "below": "fell below", "on_target": "stayed at"}
EXPLANATION = (
    "{metric} ({segment}) {movement} its recent average by {deviation}% on {date} "
    "(z-score {z}, {severity}). {advice}."
)

INSIGHT_COLUMNS = (
    "metric_date", "metric_name", "segment", "metric_value", "rolling_14d_avg", "z_score",
    "drift_severity", "drift_direction", "pct_deviation", "ai_insight",
)


def _slots(average: str = "rolling_14d_avg") -> dict[str, Column]:
    change = F.concat(num_text(F.col("day_over_day_pct_change")), F.lit("%"))
    return {
        "metric": F.col("metric_name"),
        "segment": F.col("segment"),
        "date": F.col("metric_date").cast("string"),
        "value": num_text(F.col("metric_value")),
        "average": num_text(round_half_up(F.col(average), 2)),
        "z": num_text(round_half_up(F.col("z_score"), 2)),
        "direction": F.col("drift_direction"),
        "severity": F.col("drift_severity"),
        "deviation": num_text(F.col("pct_deviation")),
        "weekend": F.when(F.col("is_weekend"), "yes").otherwise("no"),
        "change": F.coalesce(change, F.lit("n/a")),
    }


def _choose(key: Column, texts: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for name, text in texts.items():
        chosen = F.when(key == name, F.lit(text)).otherwise(chosen)
    return chosen


def alert_prompts(alerts: DataFrame, template: str = PROMPT) -> DataFrame:
    """Add ``prompt``, the text to send to a completion model. NULL where a needed field is NULL."""
    return alerts.withColumn("prompt", fill_template(template, _slots()))


def explain_alerts(
    alerts: DataFrame, complete: Complete | None = None, store: AnswerStore | None = None
) -> DataFrame:
    """Add an explanation to every alert and keep the ten insight columns.

    Without ``complete`` the text is made from a template inside Spark. With it, each task hands
    batches of prompts to the function and takes one text per prompt back (Arrow batches; prompts
    that are NULL get NULL). The function must be safe to repeat, as Spark may run a task again.
    With a ``store``, prompts that it has no answer to are asked at once, equal ones together, and the
    answers are read from it: later runs and repeated tasks ask nothing that has been answered.
    """
    if complete is None:
        severity, direction = F.col("drift_severity"), F.col("drift_direction")
        slots = _slots()
        slots["advice"] = _choose(severity, ADVICE)
        slots["movement"] = _choose(direction, MOVEMENT)
        slots["deviation"] = num_text(F.abs("pct_deviation"))
        return alerts.withColumn("ai_insight", fill_template(EXPLANATION, slots)).select(
            *INSIGHT_COLUMNS
        )

    prompted = alert_prompts(alerts).select(*INSIGHT_COLUMNS[:-1], "prompt")
    if store is not None:
        return store.answered(prompted, complete, "ai_insight").select(*INSIGHT_COLUMNS)
    schema = T.StructType(
        [prompted.schema[c] for c in INSIGHT_COLUMNS[:-1]]
        + [T.StructField("ai_insight", T.StringType())]
    )

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = batch["prompt"].notna()
            texts = pd.Series(None, index=batch.index, dtype=object)
            if asked.any():
                texts[asked] = list(complete(batch.loc[asked, "prompt"].tolist()))
            yield batch.drop(columns="prompt").assign(ai_insight=texts)

    return prompted.mapInPandas(answer, schema)

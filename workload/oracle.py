"""The registered queries in plain SQL, for comparison on another engine.

Statements are put together from named common table expressions; each uses only those it needs.
"""

from __future__ import annotations

import re

from tidewatch.operators.insights import ADVICE, EXPLANATION, MOVEMENT, PROMPT
from tidewatch.operators.quality import DEFAULT_RULES, NO_NOTE, SYSTEM_PATTERNS

CTES: dict[str, str] = {}
FINAL: dict[str, str] = {}


# ------------------------------------------------------------------ SQL text helpers


def dec(x: str) -> str:
    return f"cast({x} as decimal(28,8))"


def rnd(x: str, digits: int = 4) -> str:
    return f"cast(round({dec(x)}, {digits}) as double)"


def num(x: str) -> str:
    """A number as text: whole numbers without a fraction, no trailing zeros."""
    fixed = f"rtrim(rtrim(cast({dec(x)} as varchar), '0'), '.')"
    return f"case when {x} = floor({x}) then cast(cast({x} as bigint) as varchar) else {fixed} end"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def template(text: str, slots: dict[str, str]) -> str:
    parts = re.split(r"\{(\w+)\}", text)
    return " || ".join(
        f"({slots[part]})" if i % 2 else quote(part) for i, part in enumerate(parts) if part
    )


def choose(key: str, texts: dict[str, str]) -> str:
    return f"case {key} " + " ".join(
        f"when {quote(k)} then {quote(v)}" for k, v in texts.items()
    ) + " end"


# ------------------------------------------------------------------ drift tables

CTES["by_segment"] = """
    select cast(o_orderdate as date) as metric_date, o_orderpriority as segment,
           sum(cast(o_totalprice as decimal(18,2))) as amount, count(*) as n,
           count(o_totalprice) as n_amount
    from orders group by 1, 2"""
CTES["with_total"] = """
    select * from by_segment
    union all
    select metric_date, 'all', sum(amount), sum(n), sum(n_amount) from by_segment group by 1"""
CTES["metrics"] = """
    select metric_date, 'revenue' as metric_name, cast(amount as double) as metric_value, segment
    from with_total
    union all
    select metric_date, 'order_count', cast(n as double), segment from with_total
    union all
    select metric_date, 'avg_order_value',
           cast(amount as double) / nullif(cast(n_amount as double), 0), segment
    from with_total"""


def staged(source: str) -> str:
    return f"""
    select metric_date, metric_name, metric_value, segment,
           cast(dayofweek(metric_date) as integer) as day_of_week,
           dayofweek(metric_date) in (0, 6) as is_weekend
    from {source}"""


def rolled(source: str) -> str:
    return f"""
    select *, case when rolling_14d_stddev > 0 and rolling_14d_count >= 7
                   then (metric_value - rolling_14d_avg) / rolling_14d_stddev end as z_score
    from (
        select metric_date, metric_name, metric_value, segment, is_weekend,
               avg(metric_value) over w as rolling_14d_avg,
               stddev_samp(metric_value) over w as rolling_14d_stddev,
               count(*) over w as rolling_14d_count
        from {source}
        window w as (partition by metric_name, segment order by metric_date
                     rows between 13 preceding and current row))"""


def severity(z: str) -> str:
    return (
        f"case when abs({z}) >= 3 then 'critical' when abs({z}) >= 2 then 'warning' "
        f"when abs({z}) >= 1.5 then 'watch' else 'normal' end"
    )


CTES["staged"] = staged("metrics")
CTES["rolling"] = rolled("staged")
CTES["rolling_prior"] = """
    select *, case when rolling_14d_stddev > 0
                   then (metric_value - rolling_14d_avg) / rolling_14d_stddev
                   else 0.0 end as z_score
    from (
        select metric_date, metric_name, metric_value, segment, is_weekend,
               avg(metric_value) over w as rolling_14d_avg,
               stddev_pop(metric_value) over w as rolling_14d_stddev,
               count(*) over w as rolling_14d_count
        from staged
        window w as (partition by metric_name, segment order by metric_date
                     rows between 14 preceding and 1 preceding))
    where rolling_14d_count = 14"""
CTES["classified"] = f"""
    select metric_date, metric_name, segment, metric_value, rolling_14d_avg, rolling_14d_stddev,
           z_score, is_weekend, {severity('z_score')} as drift_severity,
           case when z_score > 0 then 'above' when z_score < 0 then 'below'
                else 'on_target' end as drift_direction,
           {rnd('((metric_value - rolling_14d_avg) / nullif(rolling_14d_avg, 0)) * 100', 2)}
               as pct_deviation,
           {severity('z_score')} <> 'normal' as is_drift_alert
    from rolling where z_score is not null"""
ALERTS = """
    select metric_date, metric_name, segment, metric_value, rolling_14d_avg, z_score,
           drift_severity, drift_direction, pct_deviation, is_weekend, prev_day_value,
           cast(consecutive_alert_window as bigint) as consecutive_alert_window,
           {change} as day_over_day_pct_change
    from (
        select *, lag(metric_value) over w as prev_day_value,
               {number} as consecutive_alert_window
        from classified where is_drift_alert
        window w as (partition by metric_name, segment order by metric_date))"""
CTES["alerts"] = ALERTS.format(
    change=rnd("((metric_value - prev_day_value) / nullif(prev_day_value, 0)) * 100", 2),
    number="count(*) over (partition by metric_name, segment order by metric_date "
    "rows between 2 preceding and current row)",
)
CTES["alerts_running"] = ALERTS.format(
    change=rnd("((metric_value - prev_day_value) / nullif(abs(prev_day_value), 0)) * 100", 2),
    number="row_number() over w",
)
SLOTS = {
    "metric": "metric_name",
    "segment": "segment",
    "date": "cast(metric_date as varchar)",
    "value": num("metric_value"),
    "average": num(rnd("rolling_14d_avg", 2)),
    "z": num(rnd("z_score", 2)),
    "direction": "drift_direction",
    "severity": "drift_severity",
    "deviation": num("pct_deviation"),
    "weekend": "case when is_weekend then 'yes' else 'no' end",
    "change": f"coalesce(({num('day_over_day_pct_change')}) || '%', 'n/a')",
}
EXPLAINED = template(
    EXPLANATION,
    SLOTS | {
        "deviation": num("abs(pct_deviation)"),
        "advice": choose("drift_severity", ADVICE),
        "movement": choose("drift_direction", MOVEMENT),
    },
)
CTES["insights"] = f"""
    select metric_date, metric_name, segment, metric_value, rolling_14d_avg, z_score,
           drift_severity, drift_direction, pct_deviation, {EXPLAINED} as ai_insight
    from alerts"""

ROLLED_OUT = f"""metric_date, metric_name, segment, is_weekend,
    {rnd('metric_value')} as metric_value, {rnd('rolling_14d_avg')} as rolling_14d_avg,
    {rnd('rolling_14d_stddev')} as rolling_14d_stddev, rolling_14d_count,
    {rnd('z_score')} as z_score"""
ALERTS_OUT = f"""metric_date, metric_name, segment, drift_severity, drift_direction, is_weekend,
    consecutive_alert_window, {rnd('metric_value')} as metric_value,
    {rnd('rolling_14d_avg')} as rolling_14d_avg, {rnd('z_score')} as z_score, pct_deviation,
    {rnd('prev_day_value')} as prev_day_value, day_over_day_pct_change"""

FINAL["stg_daily_metrics"] = f"""select metric_date, metric_name,
    {rnd('metric_value')} as metric_value, segment, day_of_week, is_weekend from staged"""
FINAL["metric_rolling_stats"] = f"select {ROLLED_OUT} from rolling"
FINAL["metric_rolling_stats_prior"] = f"select {ROLLED_OUT} from rolling_prior"
FINAL["classified_drift"] = f"""select metric_date, metric_name, segment, is_weekend,
    {rnd('metric_value')} as metric_value, {rnd('rolling_14d_avg')} as rolling_14d_avg,
    {rnd('rolling_14d_stddev')} as rolling_14d_stddev, {rnd('z_score')} as z_score,
    drift_severity, drift_direction, pct_deviation, is_drift_alert from classified"""
FINAL["drift_alerts"] = f"select {ALERTS_OUT} from alerts"
FINAL["drift_alerts_running"] = f"select {ALERTS_OUT} from alerts_running"
FINAL["drift_prompts"] = f"""select metric_date, metric_name, segment,
    {template(PROMPT, SLOTS)} as prompt from alerts"""
FINAL["drift_insights"] = f"""select metric_date, metric_name, segment,
    {rnd('metric_value')} as metric_value, {rnd('rolling_14d_avg')} as rolling_14d_avg,
    {rnd('z_score')} as z_score, drift_severity, drift_direction, pct_deviation, ai_insight
    from insights"""
FINAL["drift_insights_stored"] = f"""select metric_date, metric_name, segment,
    {rnd('metric_value')} as metric_value, {rnd('rolling_14d_avg')} as rolling_14d_avg,
    {rnd('z_score')} as z_score, drift_severity, drift_direction, pct_deviation,
    upper({template(PROMPT, SLOTS)}) as ai_insight from alerts"""


# ------------------------------------------------------------------ checks


def measured(check: str, columns: str, value: str, source: str, table: str = "T") -> str:
    """One measurement: ``value`` is an aggregate over ``source`` (or a scalar query)."""
    if value.startswith("("):
        body, tail = value, ""
    else:
        body, tail = value, f" from {source}"
    return (
        f"select {quote(table)} as table_name, {quote(check)} as check_name, "
        f"{quote(columns)} as columns, {rnd(f'cast({body} as double)')} as value{tail}"
    )


def duplicates(columns: str, source: str) -> str:
    return (
        f"(select coalesce(sum(n - 1), 0) from "
        f"(select count(*) as n from {source} group by {columns}))"
    )


def volume(date: str, source: str) -> str:
    counts = f"select {date} as d, count(*) as n from {source} group by 1"
    newest = f"(select max({date}) from {source})"
    return (
        f"(select case when count(*) filter (d = {newest}) = 0 then null "
        f"when stddev_samp(n) filter (d < {newest}) > 0 and "
        f"abs((max(n) filter (d = {newest}) - avg(n) filter (d < {newest})) / "
        f"stddev_samp(n) filter (d < {newest})) > 2 then 1 else 0 end from ({counts}))"
    )


def shift(date: str, value: str, source: str) -> str:
    newest = f"(select max({date}) from {source})"
    return (
        f"(select case when stddev_samp({value}) filter ({date} < {newest}) > 0 then "
        + rnd(
            f"(avg({value}) filter ({date} = {newest}) - avg({value}) filter ({date} < {newest}))"
            f" / stddev_samp({value}) filter ({date} < {newest})",
            4,
        )
        + f" end from {source})"
    )


def gaps(date: str, source: str) -> str:
    return (
        f"(select count(*) from (select {date} as d, lag({date}) over (order by {date}) as p "
        f"from (select distinct {date} from {source})) where datediff('day', p, d) > 1)"
    )


CTES["dated_orders"] = "select cast(o_orderdate as date) as d, o_totalprice as v from orders"
CTES["dated_lineitem"] = "select cast(l_shipdate as date) as d, l_quantity as v from lineitem"
CTES["dated_events"] = "select cast(ts as date) as d, value as v from events"
DATED = {"ORDERS": "dated_orders", "LINEITEM": "dated_lineitem", "EVENTS": "dated_events"}


def outside(values: str, column: str) -> str:
    return f"count(*) filter ({column} not in ({values}))"


def union(*selects: str) -> str:
    return "\nunion all\n".join(selects)


SECONDS = "cast(floor(epoch(timestamp '{}' - max({}))) as bigint)"

FINAL["check_null_count"] = measured(
    "NULL_COUNT", "event_type", "count(*) filter (nullif(event_type, 'error') is null)", "events"
)
FINAL["check_row_count"] = measured("ROW_COUNT", "", "count(*)", "lineitem")
FINAL["check_freshness"] = measured(
    "FRESHNESS", "ts", SECONDS.format("2024-02-01 00:00:00", "ts"), "events"
)
FINAL["check_duplicate_count"] = measured(
    "DUPLICATE_COUNT", "l_orderkey,l_linenumber",
    duplicates("l_orderkey, l_linenumber", "lineitem"), ""
)
FINAL["check_min"] = measured("MIN", "c_acctbal", "min(c_acctbal)", "customer")
FINAL["check_max"] = measured("MAX", "p_retailprice", "max(p_retailprice)", "part")
FINAL["check_cardinality"] = measured(
    "CARDINALITY", "c_mktsegment", "count(distinct c_mktsegment)", "customer"
)
FINAL["check_value_range"] = union(
    measured("VALUE_RANGE", "l_returnflag,l_discount",
             "count(*) filter (l_returnflag = 'R' and (l_discount < 0.02::double "
             "or l_discount > 0.08::double))", "lineitem"),
    measured("VALUE_RANGE", "l_linestatus,l_tax",
             "count(*) filter (l_linestatus = 'O' and (l_tax < 0 or l_tax > 0.08::double))",
             "lineitem"),
)
FINAL["check_non_negative"] = measured(
    "NON_NEGATIVE", "c_mktsegment,c_acctbal",
    "count(*) filter (c_mktsegment = 'BUILDING' and c_acctbal < 0)", "customer"
)
FINAL["check_positive"] = measured(
    "POSITIVE", "c_mktsegment,c_acctbal",
    "count(*) filter (c_mktsegment = 'MACHINERY' and c_acctbal <= 0)", "customer"
)
FINAL["check_volume_anomaly"] = union(
    *(measured("VOLUME_ANOMALY", "d", volume("d", s), "", n) for n, s in DATED.items())
)
FINAL["check_mean_drift"] = union(
    *(measured("MEAN_DRIFT", "d,v", shift("d", "v", s), "", n) for n, s in DATED.items())
)
FINAL["check_accepted_values"] = union(
    measured("ACCEPTED_VALUES", "o_orderpriority",
             outside("'1-URGENT', '2-HIGH', '3-MEDIUM'", "o_orderpriority"), "orders"),
    measured("ACCEPTED_VALUES", "o_orderstatus", outside("'F', 'O', 'P'", "o_orderstatus"),
             "orders"),
)
FINAL["check_abs_bound"] = measured(
    "ABS_BOUND", "z_score", "count(*) filter (abs(z_score) > 5)", "rolling_prior"
)
FINAL["check_readiness"] = measured(
    "READINESS", "z_score", "count(*) filter (z_score is null)", "rolling"
)
FINAL["check_date_gaps"] = union(
    *(measured("DATE_GAPS", "d", gaps("d", s), "", n) for n, s in DATED.items())
)
NAMED = "metric_name,metric_value"
FINAL["check_suite"] = union(
    measured("NULL_COUNT", "metric_value", "count(*) filter (metric_value is null)", "staged",
             "RAW"),
    measured("ROW_COUNT", "", "count(*)", "staged", "RAW"),
    measured("FRESHNESS", "metric_date",
             SECONDS.format("2002-01-01 00:00:00", "cast(metric_date as timestamp)"), "staged",
             "RAW"),
    measured("MIN", "metric_value", "min(metric_value)", "staged", "RAW"),
    measured("MAX", "metric_value", "max(metric_value)", "staged", "RAW"),
    measured("CARDINALITY_METRIC_NAME", "metric_name", "count(distinct metric_name)", "staged",
             "RAW"),
    measured("CONVERSION_RATE_VALID", NAMED,
             "count(*) filter (metric_name = 'avg_order_value' and "
             "(metric_value < 50000 or metric_value > 400000))", "staged", "RAW"),
    measured("REVENUE_NON_NEGATIVE", NAMED,
             "count(*) filter (metric_name = 'revenue' and metric_value < 0)", "staged", "RAW"),
    measured("ACTIVE_USERS_POSITIVE", NAMED,
             "count(*) filter (metric_name = 'order_count' and metric_value <= 0)", "staged",
             "RAW"),
    measured("DATE_GAPS", "metric_date", gaps("metric_date", "staged"), "", "RAW"),
    measured("NULL_COUNT", "z_score", "count(*) filter (z_score is null)", "classified", "DRIFT"),
    measured("NULL_COUNT", "drift_severity", "count(*) filter (drift_severity is null)",
             "classified", "DRIFT"),
    measured("DUPLICATE_COUNT", "metric_date,metric_name,segment",
             duplicates("metric_date, metric_name, segment", "classified"), "", "DRIFT"),
    measured("VOLUME_ANOMALY", "metric_date", volume("metric_date", "classified"), "", "DRIFT"),
    measured("MEAN_DRIFT", "metric_date,metric_value",
             shift("metric_date", "metric_value", "classified"), "", "DRIFT"),
    measured("SEVERITY_VALID", "drift_severity",
             outside("'critical', 'warning', 'watch', 'normal'", "drift_severity"), "classified",
             "DRIFT"),
    measured("ZSCORE_PLAUSIBLE", "z_score", "count(*) filter (abs(z_score) > 10)", "classified",
             "DRIFT"),
    measured("Z_SCORE_READINESS", "z_score", "count(*) filter (z_score is null)", "classified",
             "DRIFT"),
    measured("DATE_GAPS", "metric_date", gaps("metric_date", "classified"), "", "DRIFT"),
    measured("Z_SCORE_READINESS", "z_score", "count(*) filter (z_score is null)", "rolling",
             "ROLLING"),
)
FINAL["check_sql_bodies"] = union(
    measured("SQL_CARDINALITY", "metric_name", "count(distinct metric_name)", "staged", "RAW"),
    measured("SQL_VALUE_RANGE", NAMED,
             "count(*) filter (metric_name = 'avg_order_value' and "
             "(metric_value < 50000 or metric_value > 400000))", "staged", "RAW"),
    measured("SQL_AT_LEAST", NAMED,
             "count(*) filter (metric_name = 'revenue' and metric_value < 0)", "staged", "RAW"),
    measured("SQL_ABOVE", NAMED,
             "count(*) filter (metric_name = 'order_count' and metric_value <= 0)", "staged", "RAW"),
    measured("SQL_DATE_GAPS", "metric_date", gaps("metric_date", "staged"), "", "RAW"),
    measured("SQL_VOLUME", "metric_date", volume("metric_date", "classified"), "", "DRIFT"),
    measured("SQL_MEAN_SHIFT", "metric_date,metric_value",
             shift("metric_date", "metric_value", "classified"), "", "DRIFT"),
    measured("SQL_SEVERITY", "drift_severity",
             outside("'critical', 'warning', 'watch', 'normal'", "drift_severity"), "classified",
             "DRIFT"),
    measured("SQL_ABS_BOUND", "z_score", "count(*) filter (abs(z_score) > 10)", "classified", "DRIFT"),
    measured("SQL_READINESS", "z_score", "count(*) filter (z_score is null)", "classified", "DRIFT"),
)


# ------------------------------------------------------------------ quality log

CTES["event_rows"] = """
    select ts, cast(ts as date) as metric_date, event_type as metric_name,
           case when value <= 400 then value end as metric_value,
           case when value <= 400 then value end - 0.3::double as net_value, user_id
    from events"""
CTES["event_metrics"] = """
    select metric_date, 'event_count' as metric_name, cast(n as double) as metric_value, segment
    from event_totals
    union all
    select metric_date, 'value_total', cast(amount as double), segment from event_totals"""
CTES["event_totals"] = """
    select cast(ts as date) as metric_date, event_type as segment, count(*) as n,
           sum(cast(value as decimal(18,2))) as amount
    from events group by 1, 2
    union all
    select cast(ts as date), 'all', count(*), sum(cast(value as decimal(18,2)))
    from events group by 1"""
CTES["event_staged"] = staged("event_metrics")
CTES["event_rolled"] = rolled("event_staged")
CTES["event_rolling"] = f"""
    select *, case when z_score is not null then {severity('z_score')} end as drift_severity
    from event_rolled"""

AT = "cast(metric_date as timestamp) + interval 1 day + interval 8 hours"


def daily(schema: str, name: str, columns: str, value: str, source: str, table: str) -> str:
    return (
        f"select {AT} as measured_at, 'WATCH' as db_name, '{table[0]}' as schema_name, "
        f"'{table[1]}' as table_name, 'WATCH.{schema}.{name}' as dmf_name, "
        f"'{columns}' as columns, cast({value} as double) as dmf_value "
        f"from {source} group by metric_date"
    )


def once(schema: str, name: str, columns: str, value: str) -> str:
    return (
        f"select timestamp '2024-02-01 08:00:00', 'WATCH', 'RAW', 'EVENTS', "
        f"'WATCH.{schema}.{name}', '{columns}', cast({value} as double)"
    )


RAW, MART = ("RAW", "EVENTS"), ("MARTS", "EVENT_ROLLING")
CTES["measurements"] = union(
    daily("CORE", "NULL_COUNT", "metric_value", "count(*) filter (metric_value is null)",
          "event_rows", RAW),
    daily("CORE", "ROW_COUNT", "", "count(*)", "event_rows", RAW),
    daily("CORE", "FRESHNESS", "ts",
          "floor(epoch(cast(metric_date as timestamp) + interval 1 day - max(ts)))",
          "event_rows", RAW),
    daily("CORE", "MIN", "metric_value", "min(metric_value)", "event_rows", RAW),
    daily("CORE", "MAX", "metric_value", "max(metric_value)", "event_rows", RAW),
    daily("RULES", "CONVERSION_RATE_VALID", NAMED,
          "count(*) filter (metric_name = 'click' and (metric_value < 0 or metric_value > 250))",
          "event_rows", RAW),
    daily("RULES", "REVENUE_NON_NEGATIVE", "metric_name,net_value",
          "count(*) filter (metric_name = 'purchase' and net_value < 0)", "event_rows", RAW),
    daily("RULES", "ACTIVE_USERS_POSITIVE", "metric_name,net_value",
          "count(*) filter (metric_name = 'view' and net_value <= 0)", "event_rows", RAW),
    once("CORE", "DUPLICATE_COUNT", "user_id,metric_name,metric_date",
         duplicates("user_id, metric_name, metric_date", "event_rows")),
    once("RULES", "CARDINALITY_METRIC_NAME", "metric_name",
         "(select count(distinct metric_name) from event_rows)"),
    once("RULES", "VOLUME_ANOMALY", "metric_date", volume("metric_date", "event_rows")),
    once("RULES", "MEAN_DRIFT", "metric_date,metric_value",
         shift("metric_date", "metric_value", "event_rows")),
    once("RULES", "DATE_GAPS", "metric_date", gaps("metric_date", "event_rows")),
    daily("CORE", "NULL_COUNT", "z_score", "count(*) filter (z_score is null)", "event_rolling",
          MART),
    daily("CORE", "NULL_COUNT", "drift_severity", "count(*) filter (drift_severity is null)",
          "event_rolling", MART),
    daily("RULES", "Z_SCORE_READINESS", "z_score", "count(*) filter (z_score is null)",
          "event_rolling", MART),
    daily("RULES", "ZSCORE_PLAUSIBLE", "z_score", "count(*) filter (abs(z_score) > 2)",
          "event_rolling", MART),
    daily("RULES", "SEVERITY_VALID", "drift_severity",
          outside("'critical', 'warning', 'normal'", "drift_severity"), "event_rolling", MART),
)


def _rule_case(what: str) -> str:
    whens = []
    for rule in DEFAULT_RULES:
        violated = re.sub(r"\bv\b", "dmf_value", rule.violated)
        hit = f"dmf_name ilike '{rule.pattern}' and ({violated})"
        if what == "status":
            whens.append(f"when {hit} then {quote(rule.status)}")
        elif rule.note is not None:
            note = template(rule.note, {"value": num("dmf_value"), "table": "table_name"})
            whens.append(f"when {hit} then {note}")
    return "case " + "\n ".join(whens) + (
        " else 'pass' end" if what == "status" else f" else {quote(NO_NOTE)} end"
    )


SYSTEM = " or ".join(f"dmf_name ilike '{p}'" for p in SYSTEM_PATTERNS)
CTES["log"] = f"""
    select *, {_rule_case('status')} as quality_status, {_rule_case('note')} as quality_note,
           case when {SYSTEM} then 'system' else 'custom' end as check_type
    from measurements"""
STATUS_RANK = "case quality_status when 'fail' then 0 when 'warn' then 1 else 2 end"
IN_DATES = "cast(measured_at as date) between date '2024-01-10' and date '2024-01-20'"


def latest(source: str, within: str = "") -> str:
    return f"""
    select * from (
        select *, row_number() over (
            partition by dmf_name, table_name{within}
            order by measured_at desc, {STATUS_RANK}, dmf_value desc nulls last,
                     quality_note desc, columns desc) as newest
        from {source}) where newest = 1"""


DEDUCTION = """case quality_status when 'fail' then 8.0 when 'warn' then 2.0 else 0.0 end
    * case check_type when 'system' then 1.5 else 1.0 end"""
CTES["newest"] = latest("log")
CTES["newest_failing"] = latest(
    f"(select * from log where quality_status = 'fail' and {IN_DATES})"
)
CTES["newest_per_day"] = latest("log", ", cast(measured_at as date)")
CTES["breakdown"] = f"select *, cast({DEDUCTION} as double) as deduction from newest"
CTES["score"] = """
    select cast(greatest(0, round_even(100 - lost, 0)) as integer) as score, *
    from (
        select coalesce(sum(deduction), 0) as lost, count(*) as total_checks,
               count(*) filter (quality_status = 'pass') as passing,
               count(*) filter (quality_status = 'warn') as warnings,
               count(*) filter (quality_status = 'fail') as failures
        from breakdown)"""

LATEST_OUT = f"""dmf_name, table_name, check_type, quality_status,
    {rnd('dmf_value')} as dmf_value, quality_note, measured_at"""
FINAL["quality_log"] = f"""select measured_at, db_name, schema_name, table_name, dmf_name,
    {rnd('dmf_value')} as dmf_value, columns, quality_status, quality_note from log"""
FINAL["check_type_tag"] = """select dmf_name, check_type, count(*) as n
    from log group by 1, 2"""
FINAL["log_filter"] = f"""select {LATEST_OUT} from log
    where quality_status = 'fail' and check_type = 'custom' and {IN_DATES}"""
FINAL["latest_status"] = f"select {LATEST_OUT} from newest"
FINAL["latest_status_filtered"] = f"select {LATEST_OUT} from newest_failing"
FINAL["check_value_trend"] = f"""select measured_at, table_name,
    'revenue_non_negative' as check_label, {rnd('dmf_value')} as dmf_value, quality_status,
    '= 0 to pass' as threshold_label, cast(0 as double) as threshold_value
    from log where dmf_name = 'WATCH.RULES.REVENUE_NON_NEGATIVE'"""
FINAL["health_breakdown"] = f"select {LATEST_OUT}, deduction from breakdown"
FINAL["health_score"] = """select score,
    case when score >= 95 then 'A' when score >= 85 then 'B' when score >= 70 then 'C'
         when score >= 50 then 'D' else 'F' end as grade,
    case when total_checks = 0 then 'No Data' when score >= 95 then 'Healthy'
         when score >= 85 then 'Monitoring' when score >= 70 then 'At Risk'
         when score >= 50 then 'Degraded' else 'Critical' end as status_label,
    total_checks, passing, warnings, failures, cast(lost as double) as deduction
    from score"""
FINAL["score_history"] = f"""select cast(measured_at as date) as date,
    cast(greatest(0, round_even(100 - sum({DEDUCTION}), 0)) as integer) as score,
    count(*) filter (quality_status = 'fail') as failures,
    count(*) filter (quality_status = 'warn') as warnings
    from newest_per_day group by 1"""




def nulls(source: str, *columns: str) -> str:
    return union(
        *(
            f"select {quote(c)} as column_name, count(*) filter ({c} is null) as failing_rows "
            f"from {source}"
            for c in columns
        )
    )


def unexpected(source: str, column: str, accepted: str) -> str:
    return (
        f"select {column} as value_field, count(*) as n_records from {source} "
        f"where {column} not in ({accepted}) group by 1"
    )


FINAL["expect_not_null"] = union(
    nulls("staged", "metric_date", "metric_name", "metric_value"),
    nulls("rolling", "z_score"),
    nulls("classified", "is_drift_alert"),
    nulls("log", "measured_at", "table_name", "dmf_name", "dmf_value", "quality_status",
          "quality_note"),
)
FINAL["expect_accepted_values"] = union(
    unexpected("staged", "metric_name", "'revenue', 'order_count'"),
    unexpected("classified", "drift_severity", "'critical', 'warning', 'watch'"),
    unexpected("log", "quality_status", "'pass'"),
)


# ------------------------------------------------------------------ reports

FINAL["kpi_summary"] = """select score, total_checks, passing,
    cast(round_even(passing / greatest(total_checks, 1) * 100, 0) as integer) as pass_rate,
    failures, warnings, drift_alerts, critical_alerts, affected_metrics
    from score, (select count(*) as drift_alerts,
                        count(*) filter (drift_severity = 'critical') as critical_alerts,
                        count(distinct metric_name) as affected_metrics from alerts)"""
FINAL["active_issues"] = f"""select {LATEST_OUT}, deduction from breakdown
    where quality_status in ('fail', 'warn')
    order by {STATUS_RANK}, dmf_name, table_name limit 6"""
FINAL["alerts_by_severity"] = """select s.drift_severity, count(a.metric_name) as count
    from (values ('critical'), ('warning'), ('watch')) s(drift_severity)
    left join alerts a on a.drift_severity = s.drift_severity group by 1"""
FINAL["alerts_by_metric"] = "select metric_name, count(*) as count from alerts group by 1"
FINAL["daily_pass_rate"] = """select date, pass, warn, fail, pass + warn + fail as total,
    round_even(pass / greatest(pass + warn + fail, 1) * 100, 1) as pass_rate
    from (select cast(measured_at as date) as date,
                 count(*) filter (quality_status = 'pass') as pass,
                 count(*) filter (quality_status = 'warn') as warn,
                 count(*) filter (quality_status = 'fail') as fail from log group by 1)"""
FINAL["issue_heatmap"] = """select check_label, date, issues,
    cast(sum(issues) over (partition by check_label) as bigint) as total_issues
    from (select lower(split_part(dmf_name, '.', -1)) as check_label,
                 cast(measured_at as date) as date, count(*) as issues
          from log where quality_status in ('fail', 'warn') group by 1, 2)"""
FINAL["weekly_alert_counts"] = """select cast(date_trunc('week', metric_date) as date) as week,
    metric_name, count(*) filter (drift_severity = 'critical') as critical,
    count(*) filter (drift_severity = 'warning') as warning,
    count(*) filter (drift_severity = 'watch') as watch
    from classified where is_drift_alert group by 1, 2"""
FINAL["zscore_distribution"] = f"""select metric_name, count(*) as n,
    {rnd('avg(z_score)')} as mean_z, {rnd('min(z_score)')} as min_z,
    {rnd('quantile_cont(z_score, 0.25)')} as q1, {rnd('quantile_cont(z_score, 0.5)')} as median,
    {rnd('quantile_cont(z_score, 0.75)')} as q3, {rnd('max(z_score)')} as max_z
    from classified group by 1"""
FINAL["alerts_by_metric_severity"] = """select metric_name, drift_severity, count(*) as count
    from classified where is_drift_alert group by 1, 2"""
IN_ALERT_DATES = "metric_date between date '1996-01-01' and date '1998-12-31'"
FINAL["alert_feed_page"] = f"""select {ALERTS_OUT} from (
    select * from alerts where {IN_ALERT_DATES}
    order by case drift_severity when 'critical' then 0 when 'warning' then 1 else 2 end,
             metric_date desc, metric_name, segment
    limit 10 offset 10)"""
FINAL["alert_feed_size"] = f"""select count(*) as total,
    cast(greatest(1, ceil(count(*) / 10)) as bigint) as total_pages
    from alerts where drift_severity = 'warning' and {IN_ALERT_DATES}"""
FINAL["alert_insight_join"] = f"""select a.metric_date, a.metric_name, a.segment,
    a.drift_severity, {rnd('a.metric_value')} as metric_value,
    coalesce(i.ai_insight, '') as ai_insight
    from alerts a left join insights i
    on a.metric_date = i.metric_date and a.metric_name = i.metric_name and a.segment = i.segment"""
FINAL["series_band"] = f"""select metric_date, {rnd('metric_value')} as metric_value,
    {rnd('rolling_14d_avg')} as rolling_14d_avg,
    {rnd('rolling_14d_avg - rolling_14d_stddev')} as band_low,
    {rnd('rolling_14d_avg + rolling_14d_stddev')} as band_high
    from classified where metric_name = 'revenue' and segment = '1-URGENT' and {IN_ALERT_DATES}"""
FINAL["alert_markers"] = f"""select a.metric_date, a.drift_severity,
    {rnd('a.metric_value')} as metric_value_a, {rnd('s.metric_value')} as metric_value
    from (select * from alerts where metric_name = 'revenue' and segment = 'all') a
    left join (select metric_date, metric_value from classified
               where metric_name = 'revenue' and segment = 'all') s
    on a.metric_date = s.metric_date"""
FINAL["pick_lists"] = """select distinct 'metric' as field, metric_name as choice from classified
    union all select distinct 'segment', segment from classified
    union all select distinct 'check', dmf_name from log"""


# ------------------------------------------------------------------ continuous measurement

CTES["arrived"] = "select *, cast(ts as date) as d from events"


def event_suite(source: str) -> str:
    """The measurements of ``event_checks`` in the workload."""
    return union(
        *(
            measured(check, columns, value, source, "EVENTS")
            for check, columns, value in (
                ("ROW_COUNT", "", "count(*)"),
                ("NULL_COUNT", "value", "count(*) filter (value is null)"),
                ("FRESHNESS", "ts", SECONDS.format("2024-02-01 00:00:00", "ts")),
                ("MIN", "value", "min(value)"),
                ("MAX", "value", "max(value)"),
                ("VALUE_RANGE", "event_type,value",
                 "count(*) filter (event_type = 'click' and (value < 0 or value > 250))"),
                ("VOLUME_ANOMALY", "d", volume("d", source)),
                ("MEAN_DRIFT", "d,value", shift("d", "value", source)),
                ("DATE_GAPS", "d", gaps("d", source)),
                ("CARDINALITY", "event_type", "count(distinct event_type)"),
                ("DUPLICATE_COUNT", "user_id,event_type,d",
                 duplicates("user_id, event_type, d", source)),
            )
        )
    )


FINAL["drift_alerts_appended"] = FINAL["drift_alerts"]
FINAL["monitor_stream"] = event_suite("arrived")
CTES["rebuilt"] = """
select event_type, user_id, ts, case when event_type = 'click' then value + 1 else value end as value, cast(ts as date) as d
from events
union all
select event_type, user_id, ts, value, cast(ts as date) from events where event_type = 'purchase'
"""
FINAL["monitor_rebuilt"] = event_suite("rebuilt")

CTES["timed_lines"] = """
select cast(l_shipdate as date) as shipped, cast(l_shipdate as date) + cast(l_linenumber * l_linenumber as integer) as due,
       l_quantity as quantity, l_orderkey, l_linenumber, l_partkey, l_returnflag
from lineitem
"""
FINAL["check_suite_two_dates"] = union(
    *(
        measured(check, columns, value, "timed_lines", "LINES")
        for check, columns, value in (
            ("ROW_COUNT", "", "count(*)"),
            ("DATE_GAPS", "shipped", gaps("shipped", "timed_lines")),
            ("DATE_GAPS", "due", gaps("due", "timed_lines")),
            ("VOLUME_ANOMALY", "due", volume("due", "timed_lines")),
            ("MEAN_DRIFT", "shipped,quantity", shift("shipped", "quantity", "timed_lines")),
            ("MEAN_DRIFT", "due,quantity", shift("due", "quantity", "timed_lines")),
            ("MAX", "quantity", "max(quantity)"),
            ("DUPLICATE_COUNT", "l_orderkey,l_linenumber", duplicates("l_orderkey, l_linenumber", "timed_lines")),
            ("DUPLICATE_COUNT", "l_partkey,shipped", duplicates("l_partkey, shipped", "timed_lines")),
            ("CARDINALITY", "l_partkey", "count(distinct l_partkey)"),
            ("CARDINALITY", "l_returnflag", "count(distinct l_returnflag)"),
        )
    )
)


FINAL["exact_daily_means"] = """
with wide as (
    select cast(l_shipdate as date) as metric_date, l_returnflag as segment,
           avg(l_discount) as discount_mean, avg(l_tax) as tax_mean, sum(l_tax) as tax_total
    from lineitem group by 1, 2
    union all
    select cast(l_shipdate as date), 'all', avg(l_discount), avg(l_tax), sum(l_tax)
    from lineitem group by 1
)
select metric_date, 'discount_mean' as metric_name, round(discount_mean, 9) as metric_value, segment from wide
union all select metric_date, 'tax_mean', round(tax_mean, 9), segment from wide
union all select metric_date, 'tax_total', round(tax_total, 9), segment from wide
"""
_LATE, _LATER = "timestamp '2024-02-01 23:59:00'", "timestamp '2024-02-02 00:01:00'"
FINAL["measurement_history"] = union(
    *(
        f"""select '{name}' as table_name, '{check}' as check_name, cast({value} as double) as value,
        {at} as measurement_time, date '2024-02-01' as measured_date, cast(0 as bigint) as batch_id from {source}"""
        for name, source, day, at in (
            ("ORDERS", "orders", "o_orderdate", _LATER), ("LINEITEM", "lineitem", "l_shipdate", _LATE)
        )
        for check, value in (
            ("ROW_COUNT", "count(*)"),
            ("FRESHNESS", f"date_diff('second', max(cast({day} as timestamp)), {at})"),
        )
    )
)


def _needed(sql: str) -> list[str]:
    """Names of the expressions that a statement needs, each after those it needs itself."""
    found: list[str] = []
    for name in CTES:
        if re.search(rf"\b(from|join|,) \(?{name}\b", sql):
            for other in (*_needed(CTES[name]), name):
                if other not in found:
                    found.append(other)
    return found


def statements() -> dict[str, str]:
    result = {}
    for key, sql in FINAL.items():
        names = _needed(sql)
        head = ",\n".join(f"{name} as materialized ({CTES[name]})" for name in names)
        result[key] = f"with {head}\n{sql}" if names else sql
    return result

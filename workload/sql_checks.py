"""Checks whose bodies are SQL: the counterparts of the built-in ones, with declared column types."""

from __future__ import annotations

from tidewatch.operators.checks import sql_check

NAMED = {"name": "string", "value": "double"}

kinds = sql_check("SQL_CARDINALITY", {"item": "string"}, "select count(distinct item) from {arg_t}", "bigint")
in_range = sql_check(
    "SQL_VALUE_RANGE", NAMED,
    "select count(*) from {arg_t} where name = :metric and value not between :low and :high", "bigint",
)
at_least = sql_check(
    "SQL_AT_LEAST", NAMED, "select count(*) from {arg_t} where name = :metric and value < :low", "bigint"
)
above = sql_check(
    "SQL_ABOVE", NAMED, "select count(*) from {arg_t} where name = :metric and value <= :low", "bigint"
)
listed = sql_check(
    "SQL_SEVERITY", {"severity": "string"},
    "select count_if(not array_contains(array('critical', 'warning', 'watch', 'normal'), severity)) from {arg_t}",
    "bigint",
)
plausible = sql_check(
    "SQL_ABS_BOUND", {"score": "double"}, "select count(*) from {arg_t} where abs(score) > :bound", "bigint"
)
ready = sql_check("SQL_READINESS", {"score": "double"}, "select count(*) - count(score) from {arg_t}", "bigint")
gaps = sql_check(
    "SQL_DATE_GAPS", {"day": "date"},
    """
    with days as (select distinct day from {arg_t} where day is not null),
    steps as (select datediff(day, lag(day) over (order by day)) as step from days)
    select count(*) from steps where step > 1
    """,
    "bigint",
)
volume = sql_check(
    "SQL_VOLUME", {"day": "date"},
    """
    with sizes as (select day, count(*) as n from {arg_t} where day is not null group by day),
    marked as (select n, day = max(day) over () as newest from sizes),
    known as (
        select max(n) filter (where newest) as n, avg(n) filter (where not newest) as mean,
               stddev_samp(n) filter (where not newest) as spread
        from marked
    )
    select if(n is null, null, if(spread > 0 and abs(n - mean) > 2 * spread, 1, 0)) from known
    """,
    "int",
)
shift = sql_check(
    "SQL_MEAN_SHIFT", {"day": "date", "value": "double"},
    """
    with last as (select max(day) as newest from {arg_t}),
    known as (
        select avg(value) filter (where day = newest) as now, avg(value) filter (where day < newest) as mean,
               stddev_samp(value) filter (where day < newest) as spread
        from {arg_t} cross join last
    )
    select round((now - mean) / nullif(spread, 0), 4) from known
    """,
)

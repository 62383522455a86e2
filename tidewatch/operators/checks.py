"""Data-quality checks: each takes some columns of a table and gives one number.

Three families, by what they need:

* ``RowCheck``: an aggregate over rows whose partial results merge by sum, min or max.
* ``SeriesCheck``: needs the table's rows per date (volume, mean shift, gaps). It keeps a few
  partial aggregates per date and finishes over the dates, a set bounded by the calendar.
* ``KeyedCheck``: needs the distinct values or keys of the table; gives a one-row frame.

Row and series checks of a table share one pass over it (see ``tidewatch.operators.suite``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.numeric import round_half_up, seconds_between, wall_clock

SYSTEM_SCHEMA = "CORE"
CUSTOM_SCHEMA = "RULES"


_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widens(given: T.DataType, declared: T.DataType) -> bool:
    """Whether a column of one type can be handed over as another."""
    if given == declared or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.NumericType) and isinstance(declared, T.DoubleType):
        return True
    if isinstance(given, T.StringType) and isinstance(declared, T.StringType):
        return True
    scale = given.scale if isinstance(given, T.DecimalType) else 0
    digits = given.precision - scale if isinstance(given, T.DecimalType) else _WHOLE_DIGITS.get(type(given))
    if digits is None:
        return isinstance(given, T.DateType) and isinstance(declared, T.TimestampNTZType)
    if isinstance(declared, T.DecimalType):
        return scale <= declared.scale and digits <= declared.precision - declared.scale
    return not isinstance(given, T.DecimalType) and digits <= _WHOLE_DIGITS.get(type(declared), 0)


@dataclass(frozen=True)
class Lookup:
    """Name of a partial aggregate or context value -> its column; ``dates`` is the window of all dates."""

    columns: Callable[[str], Column]
    dates: WindowSpec

    def __call__(self, name: str) -> Column:
        return self.columns(name)



@dataclass(frozen=True)
class Check:
    """What all checks have: a name, the schema it is filed under, and its column arguments.

    With ``types`` (names of Spark types, one per argument) a column is taken only if its type is
    the declared one or widens to it without loss of whole digits, and arrives as the declared type.
    """

    name: str
    arguments: tuple[str, ...]
    schema: str = CUSTOM_SCHEMA
    types: tuple[str, ...] = ()

    def on(self, *columns: str, name: str | None = None, **parameters) -> Binding:
        """Bind the check to columns of a table. A check can be bound many times."""
        if self.arguments != ("*",) and len(columns) != len(self.arguments):
            raise ValueError(f"{self.name} takes the columns {self.arguments}, got {columns}")
        return Binding(self, columns, name or self.name, parameters)


@dataclass(frozen=True)
class Binding:
    check: Check
    columns: tuple[str, ...]
    name: str
    parameters: Mapping[str, object] = field(default_factory=dict)

    @property
    def column_text(self) -> str:
        return ",".join(self.columns)

    @property
    def typed_columns(self) -> list[Column]:
        """The bound columns as the check's declared types."""
        if not self.check.types:
            return [F.col(c) for c in self.columns]
        return [F.col(c).cast(t) for c, t in zip(self.columns, self.check.types, strict=True)]

    def refuse_other_types(self, df: DataFrame) -> None:
        for column, declared in zip(self.columns, self.check.types, strict=False):
            given = df.select(column).schema[0].dataType
            if not widens(given, T.DataType.fromDDL(declared)):
                raise TypeError(
                    f"{self.name} takes {declared} for {column}, which is {given.simpleString()}"
                )


@dataclass(frozen=True)
class RowCheck(Check):
    partial: Callable[..., Column] = None
    merge: str = "sum"
    # turns the merged value into the measured one; gets the binding's parameters
    finish: Callable[..., Column] | None = None
    # parameters that only ``finish`` takes
    finish_parameters: tuple[str, ...] = ()

    def partial_of(self, binding: Binding) -> Column:
        parameters = {
            k: v for k, v in binding.parameters.items() if k not in self.finish_parameters
        }
        return self.partial(*binding.typed_columns, **parameters)

    def merged(self, part: Column) -> Column:
        if self.merge == "sum":
            return F.coalesce(F.sum(part), F.lit(0))
        return {"min": F.min, "max": F.max}[self.merge](part)

    def finished(self, merged: Column, binding: Binding, measured_at: Column) -> Column:
        """The measured value; a parameter of ``finish`` that isn't bound is the time of measurement."""
        if self.finish is None:
            return merged
        given = {k: binding.parameters.get(k, measured_at) for k in self.finish_parameters}
        return self.finish(merged, **given)


@dataclass(frozen=True)
class SeriesCheck(Check):
    # columns after the date -> named aggregates over the rows of a date
    partials: Callable[..., dict[str, Column]] = None
    # named values computed over all dates before the final aggregation
    context: Callable[[Lookup], dict[str, Column]] | None = None
    # aggregate over the dates that gives the measured value
    finish: Callable[..., Column] = None
    # aggregates that make one row of several rows of partials per date (``dates`` is then one date)
    merge: Callable[[Lookup], dict[str, Column]] | None = None
    # named values over the rows of a date for ``merge``
    merge_context: Callable[[Lookup], dict[str, Column]] | None = None


@dataclass(frozen=True)
class KeyedCheck(Check):
    measure: Callable[..., DataFrame] = None


# ------------------------------------------------------------------------------ registry

REGISTRY: dict[str, Check] = {}


def register(check: Check) -> Check:
    if check.name in REGISTRY:
        raise ValueError(f"check {check.name} exists already")
    REGISTRY[check.name] = check
    return check


Arguments = Sequence[str] | Mapping[str, str]


def _declared(arguments: Arguments) -> dict[str, tuple[str, ...]]:
    """Names of arguments, and their types if they are given as a mapping."""
    types = tuple(arguments.values()) if isinstance(arguments, Mapping) else ()
    return {"arguments": tuple(arguments), "types": types}


def row_check(name: str, arguments: Arguments, merge: str = "sum", **options):
    """Decorator: register a function ``(columns...) -> aggregate Column`` as a check.

    Arguments of all three decorators are names, or a mapping of names to types.
    """

    def wrap(function: Callable[..., Column]) -> RowCheck:
        return register(
            RowCheck(name, partial=function, merge=merge, **_declared(arguments), **options)
        )

    return wrap


def series_check(name: str, arguments: Arguments, finish: Callable[..., Column], **options):
    """Decorator: register ``(columns after the date...) -> aggregates per date`` as a check.

    The first argument is the date. ``finish`` makes the value from a ``Lookup`` of the aggregates;
    ``context``, ``merge`` and ``merge_context`` are those of ``SeriesCheck``.
    """

    def wrap(function: Callable[..., dict[str, Column]]) -> SeriesCheck:
        return register(
            SeriesCheck(name, partials=function, finish=finish, **_declared(arguments), **options)
        )

    return wrap


def keyed_check(name: str, arguments: Arguments, **options):
    """Decorator: register ``(DataFrame, columns...) -> one-row DataFrame(value)`` as a check.

    The function gets the frame with just the bound columns, renamed to the declared arguments
    (or under their own names for the argument list ``["*"]``), and may run any query over it.
    """

    def wrap(function: Callable[..., DataFrame]) -> KeyedCheck:
        return register(KeyedCheck(name, measure=function, **_declared(arguments), **options))

    return wrap


def sql_check(name: str, arguments: Mapping[str, str], body: str, returns: str = "double", **options) -> KeyedCheck:
    """Register a query as a check: any SQL over ``{arg_t}``, the bound columns under the arguments' names.

    Parameters of a binding are the query's named markers (``:limit``). The query gives one number
    in one column; none is NULL, and a second row fails the measurement.
    """

    def measure(df: DataFrame, **parameters) -> DataFrame:
        found = df.sparkSession.sql(f"select ({body}) as value", args=parameters, arg_t=df)
        if not isinstance(found.schema[0].dataType, T.NumericType):
            raise TypeError(f"{name} gives {found.schema[0].dataType.simpleString()}, not a number")
        return found.select(F.col("value").cast(returns).alias("value"))

    return keyed_check(name, arguments, **options)(measure)


# ------------------------------------------------------------------------------ row checks


@row_check("NULL_COUNT", ["column"], schema=SYSTEM_SCHEMA)
def null_count(column: Column) -> Column:
    """Rows with NULL."""
    return F.count_if(column.isNull())


@row_check("ROW_COUNT", [], schema=SYSTEM_SCHEMA)
def row_count() -> Column:
    return F.count(F.lit(1))


@row_check("FRESHNESS", ["column"], merge="max", schema=SYSTEM_SCHEMA,
           finish=lambda newest, as_of: seconds_between(newest, wall_clock(as_of)),
           finish_parameters=("as_of",))
def freshness(column: Column) -> Column:
    """Seconds from the newest value to ``as_of`` (wall-clock), by default the time of measurement."""
    return F.max(column.cast("timestamp_ntz"))


@row_check("MIN", ["column"], merge="min", schema=SYSTEM_SCHEMA)
def minimum(column: Column) -> Column:
    return F.min(column)


@row_check("MAX", ["column"], merge="max", schema=SYSTEM_SCHEMA)
def maximum(column: Column) -> Column:
    return F.max(column)


@row_check("VALUE_RANGE", ["name", "value"])
def value_range(name: Column, value: Column, metric: str, low: float, high: float) -> Column:
    """Rows of one metric outside [low, high]."""
    return F.count_if((name == metric) & ((value < low) | (value > high)))


@row_check("NON_NEGATIVE", ["name", "value"])
def non_negative(name: Column, value: Column, metric: str) -> Column:
    """Rows of one metric below zero."""
    return F.count_if((name == metric) & (value < 0))


@row_check("POSITIVE", ["name", "value"])
def positive(name: Column, value: Column, metric: str) -> Column:
    """Rows of one metric at or below zero."""
    return F.count_if((name == metric) & (value <= 0))


@row_check("ACCEPTED_VALUES", ["column"])
def accepted_values(column: Column, accepted: Sequence[str]) -> Column:
    """Rows with a value outside the list. NULL is not a violation."""
    return F.count_if(~column.isin(*accepted))


@row_check("ABS_BOUND", ["column"])
def abs_bound(column: Column, bound: float = 10.0) -> Column:
    """Rows whose absolute value is above the bound."""
    return F.count_if(F.abs(column) > bound)


@row_check("READINESS", ["column"])
def readiness(column: Column) -> Column:
    """Rows without a value yet."""
    return F.count_if(column.isNull())


# ------------------------------------------------------------------------------ series checks


def _volume_finish(p: Lookup, limit: float = 2.0) -> Column:
    earlier = p("date") < p("latest")
    average = F.avg(F.when(earlier, p("rows")))
    deviation = F.stddev_samp(F.when(earlier, p("rows")))
    newest = F.max(F.when(p("date") == p("latest"), p("rows")))
    unusual = (deviation > 0) & (F.abs((newest - average) / deviation) > limit)
    return F.when(newest.isNotNull(), F.when(unusual, F.lit(1)).otherwise(F.lit(0)))


volume_anomaly = register(
    SeriesCheck(
        "VOLUME_ANOMALY",
        ("date",),
        partials=lambda: {"rows": F.count(F.lit(1))},
        finish=_volume_finish,
        merge=lambda p: {"rows": F.sum(p("rows"))},
    )
)
"""1 if the row count of the newest date is more than ``limit`` deviations from the mean of the
earlier dates' counts, else 0; NULL for an empty table."""


def _mean_partials(value: Column) -> dict[str, Column]:
    v = value.cast("double")
    return {
        "n": F.count(v),
        "mean": F.avg(v),
        "m2": F.var_pop(v) * F.count(v),
        "low": F.min(v),
        "high": F.max(v),
    }


def _mean_context(p: Lookup) -> dict[str, Column]:
    # mean of all rows before the newest date, known to every date
    weight = F.when(p("date") < p("latest"), p("n"))
    total = F.sum(weight * p("mean")).over(p.dates)
    return {"history_mean": total / F.nullif(F.sum(weight).over(p.dates), F.lit(0))}


def _mean_merge_context(p: Lookup) -> dict[str, Column]:
    total = F.sum(p("n") * p("mean")).over(p.dates)
    return {"whole_mean": total / F.nullif(F.sum(p("n")).over(p.dates), F.lit(0))}


def _mean_merge(p: Lookup) -> dict[str, Column]:
    between = p("n") * F.pow(p("mean") - p("whole_mean"), F.lit(2))
    return {
        "n": F.sum(p("n")),
        "mean": F.max(p("whole_mean")),
        "m2": F.sum(F.when(p("n") > 0, p("m2") + between)),
        "low": F.min(p("low")),
        "high": F.max(p("high")),
    }


def _mean_finish(p: Lookup, digits: int = 4) -> Column:
    earlier = p("date") < p("latest")
    # merging moments of groups: within-group plus between-group squares
    between = p("n") * F.pow(p("mean") - p("history_mean"), F.lit(2))
    squares = F.sum(F.when(earlier & (p("n") > 0), p("m2") + between))
    n = F.sum(F.when(earlier, p("n")))
    varies = F.min(F.when(earlier, p("low"))) < F.max(F.when(earlier, p("high")))
    deviation = F.sqrt(squares / F.nullif(n - 1, F.lit(0)))
    newest = F.max(F.when(p("date") == p("latest"), p("mean")))
    shift = (newest - F.max(p("history_mean"))) / deviation
    return F.when(varies, round_half_up(shift, digits))


mean_drift = register(
    SeriesCheck(
        "MEAN_DRIFT",
        ("date", "value"),
        partials=_mean_partials,
        context=_mean_context,
        finish=_mean_finish,
        merge=_mean_merge,
        merge_context=_mean_merge_context,
    )
)
"""Distance of the newest date's mean from the mean of all earlier rows, in deviations of those
rows, rounded; NULL without earlier rows or variation."""


def _gap_context(p: Lookup) -> dict[str, Column]:
    return {"previous": F.lag(p("date")).over(p.dates.orderBy(p("date")))}


def _gap_finish(p: Lookup) -> Column:
    return F.count_if(F.date_diff(p("date"), p("previous")) > 1)


date_gaps = register(
    SeriesCheck(
        "DATE_GAPS",
        ("date",),
        partials=lambda: {},
        context=_gap_context,
        finish=_gap_finish,
        merge=lambda p: {},
    )
)
"""Number of neighbouring dates that are more than one day apart (gaps, not missing days)."""


# ------------------------------------------------------------------------------ keyed checks


@keyed_check("DUPLICATE_COUNT", ["*"], schema=SYSTEM_SCHEMA)
def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of every key. NULL keys compare equal.

    Copies are merged per task before the shuffle, so a key with very many copies stays small.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("value"))


@keyed_check("CARDINALITY", ["column"])
def cardinality(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("column").alias("value"))

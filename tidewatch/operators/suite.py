"""Running many checks against a table in as few passes as possible.

All row and series checks of a table share one pass: the rows are reduced to one row of partial
aggregates per date (map-side first), and everything else happens on that small result. Partials of
several parts of a table merge. Duplicate counts and exact cardinalities share a second pass, with
one shuffle of counted keys; other keyed checks read their own columns only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.functions.numeric import wall_clock
from tidewatch.functions.text import sql_text
from tidewatch.operators.checks import (
    Binding, KeyedCheck, Lookup, RowCheck, SeriesCheck, cardinality, duplicate_count,
)

DATE = "__date"
# which of the suite's date columns a row of partials is for, if there are several
DIMENSION = "__dimension"
LATEST = "__latest"
ROWS = "__rows"


@dataclass(frozen=True)
class Suite:
    """The checks bound to one table."""

    database: str
    schema: str
    table: str
    bindings: tuple[Binding, ...]
    check_database: str | None = None

    def of_family(self, family: type) -> list[tuple[int, Binding]]:
        return [(i, b) for i, b in enumerate(self.bindings) if isinstance(b.check, family)]

    @property
    def date_columns(self) -> list[str]:
        return list(dict.fromkeys(b.columns[0] for _, b in self.of_family(SeriesCheck)))

    # ------------------------------------------------------------------ the shared pass

    def partial_columns(self) -> list[Column]:
        """Aggregates to keep per date for all row and series checks."""
        kept = [b.check.partial_of(b).alias(f"r{i}") for i, b in self.of_family(RowCheck)]
        for i, b in self.of_family(SeriesCheck):
            parts = b.check.partials(*b.typed_columns[1:])
            kept += [column.alias(f"s{i}_{name}") for name, column in parts.items()]
        return kept

    def partials(
        self, df: DataFrame, count_rows: bool = False, by: Sequence[str] = ()
    ) -> DataFrame | None:
        """One row of partial aggregates per date (a single row if no check needs dates).

        With several date columns, one row per date of each of them. None if there is nothing to keep.
        ``count_rows`` keeps the number of rows as well; ``by`` keeps parts of the table apart.
        """
        for b in self.bindings:
            b.refuse_other_types(df)
        kept = self.partial_columns()
        dates = self.date_columns
        if count_rows or (dates and not kept):
            kept.append(F.count(F.lit(1)).alias(ROWS))
        if not kept:
            return None
        groups = [F.col(c) for c in by]
        if len(dates) == 1:
            groups.append(F.col(dates[0]).cast("date").alias(DATE))
        elif dates:
            each = F.array(*(F.col(d).cast("date") for d in dates))
            df = df.select("*", F.posexplode(each).alias(DIMENSION, DATE))
            groups += [F.col(DIMENSION), F.col(DATE)]
        return df.groupBy(*groups).agg(*kept) if groups else df.agg(*kept)

    def _levels(self) -> list[str]:
        """What a row of partials is for."""
        dates = self.date_columns
        return [DIMENSION, DATE] if len(dates) > 1 else [DATE] if dates else []

    def whole_rows(self, partials: DataFrame) -> DataFrame:
        """The rows of partials that hold each row of the table once."""
        return partials.where(F.col(DIMENSION) == 0) if len(self.date_columns) > 1 else partials

    def merged(self, partials: DataFrame) -> DataFrame:
        """Partials of several parts of a table as those of the whole: one row per date again."""
        levels = self._levels()
        frame, one_date = partials, Window.partitionBy(*levels)
        kept = [b.check.merged(F.col(f"r{i}")).alias(f"r{i}") for i, b in self.of_family(RowCheck)]
        for i, b in self.of_family(SeriesCheck):
            if b.check.merge is None:
                raise ValueError(f"{b.check.name} doesn't say how its partials merge")
            lookup = _lookup(i, one_date)
            if b.check.merge_context:
                values = b.check.merge_context(lookup)
                frame = frame.withColumns({f"s{i}_{k}": v for k, v in values.items()})
            kept += [v.alias(f"s{i}_{k}") for k, v in b.check.merge(lookup).items()]
        if ROWS in partials.columns:
            kept.append(F.coalesce(F.sum(ROWS), F.lit(0)).alias(ROWS))
        return frame.groupBy(*levels).agg(*kept) if levels else frame.agg(*kept)

    def measure(self, partials: DataFrame, measured_at: Column) -> DataFrame:
        """Merge the per-date rows into one row with a column ``m<i>`` per row or series check."""
        series = self.of_family(SeriesCheck)
        dates = self.date_columns
        several = len(dates) > 1
        frame = partials
        if series:
            # windows over all dates: the frame has one row per calendar date (and date column)
            everywhere = Window.partitionBy(*([DIMENSION] if several else []))
            frame = frame.withColumn(LATEST, F.max(DATE).over(everywhere))
            for i, b in series:
                if b.check.context:
                    values = b.check.context(_lookup(i, everywhere))
                    frame = frame.withColumns({f"s{i}_{k}": v for k, v in values.items()})
        merged = []
        for i, b in self.of_family(RowCheck):
            part = F.col(f"r{i}")
            if several:
                part = F.when(F.col(DIMENSION) == 0, part)
            merged.append(b.check.merged(part).alias(f"r{i}"))
        for i, b in series:
            own = dates.index(b.columns[0]) if several else None
            merged.append(b.check.finish(_lookup(i, None, own), **b.parameters).alias(f"m{i}"))
        wide = frame.agg(*merged)
        finished = [
            b.check.finished(F.col(f"r{i}"), b, measured_at).alias(f"m{i}")
            for i, b in self.of_family(RowCheck)
        ]
        return wide.select(*finished, *(f"m{i}" for i, _ in series))

    # ------------------------------------------------------------------ keys

    def counted_keys(self) -> list[int]:
        """Bindings that need no more of their keys than how often each occurs."""
        return [
            i for i, b in self.of_family(KeyedCheck)
            if b.check is duplicate_count or b.check is cardinality and not b.parameters.get("approximate")
        ]

    def key_rows(self, df: DataFrame, which: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
        """Columns ``by``, then binding and key, for every row and binding.

        A key is laid out over typed columns that bindings share, so that it is compared as Spark
        compares values of its own type. Columns that a binding doesn't use are null.
        """
        kinds = dict(df.dtypes)
        slots: dict[str, str] = {}
        own: dict[int, dict[str, str]] = {}
        for i in which:
            taken: dict[str, int] = {}
            own[i] = {}
            for column in self.bindings[i].columns:
                kind = kinds[column]
                name = f"{kind} {taken.setdefault(kind, 0)}"
                taken[kind] += 1
                slots[name] = kind
                own[i][name] = column
        names = {name: f"k{k}" for k, name in enumerate(slots)}
        structs = [
            F.struct(
                F.lit(i).alias("binding"),
                F.lit(names[next(iter(own[i]))] if own[i] else None).alias("first"),
                *(
                    (F.col(own[i][n]) if n in own[i] else F.lit(None).cast(kind)).alias(names[n])
                    for n, kind in slots.items()
                ),
            )
            for i in which
        ]
        rows = df.select(*by, F.explode(F.array(*structs)).alias("__key"))
        filled = F.lit(False)
        for k in names.values():
            filled = filled | ((F.col("__key.first") == k) & F.col(f"__key.{k}").isNotNull())
        return rows.select(
            *by, "__key.binding", F.coalesce(filled, F.lit(False)).alias("filled"),
            *(f"__key.{k}" for k in names.values()),
        )

    @staticmethod
    def key_counts(rows: DataFrame) -> DataFrame:
        """How often each key occurs: the columns of ``key_rows`` and ``copies``."""
        return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))

    def measure_keys(self, counts: DataFrame, which: Sequence[int]) -> DataFrame:
        """One row with a column ``m<i>`` per binding, from rows (binding, keys, filled_keys, copies)."""
        values = []
        for i in which:
            distinct = self.bindings[i].check is cardinality
            value = F.col("filled_keys") if distinct else F.col("copies") - F.col("keys")
            own = F.sum(F.when(F.col("binding") == i, value))
            values.append(F.coalesce(own, F.lit(0)).alias(f"m{i}"))
        return counts.agg(*values)

    def measure_keyed(self, df: DataFrame, i: int) -> DataFrame:
        """One-row frame with the column ``m<i>``."""
        b = self.bindings[i]
        check = b.check
        b.refuse_other_types(df)
        names = b.columns if check.arguments == ("*",) else check.arguments
        argument = df.select(*(c.alias(n) for c, n in zip(b.typed_columns, names, strict=True)))
        return check.measure(argument, **b.parameters).toDF(f"m{i}")

    # ------------------------------------------------------------------ measurement rows

    def rows_of(self, wide: DataFrame, which: Sequence[int], measured_at: Column) -> DataFrame:
        """Turn the columns ``m<i>`` into one measurement row per binding and input row."""
        cells = []
        for i in which:
            b = self.bindings[i]
            cells += [
                sql_text(b.check.schema), sql_text(b.name), sql_text(b.column_text),
                f"cast(m{i} as double)",
            ]
        rows = (
            f"stack({len(which)}, {', '.join(cells)}) "
            "as (metric_schema, metric_name, columns, value)"
        )
        constants = [
            f"{sql_text(self.database)} as table_database",
            f"{sql_text(self.schema)} as table_schema",
            f"{sql_text(self.table)} as table_name",
            f"{sql_text(self.check_database or self.database)} as metric_database",
        ]
        return wide.select("*", measured_at.alias("measurement_time")).selectExpr("measurement_time", rows).selectExpr(
            "measurement_time", *constants, "metric_schema", "metric_name", "columns", "value"
        )


def key_totals(keys: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Numbers of keys, of keys whose first column isn't null, and of rows, per binding and ``by``."""
    return keys.groupBy(*by, "binding").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if("filled").alias("filled_keys"),
        F.sum("copies").alias("copies"),
    )


def _lookup(i: int, dates: WindowSpec | None, dimension: int | None = None) -> Lookup:
    """Columns of binding ``i``; of one date column's rows alone if there are several."""
    fixed = {"date": DATE, "latest": LATEST}

    def column(name: str) -> Column:
        found = F.col(fixed.get(name, f"s{i}_{name}"))
        return found if dimension is None else F.when(F.col(DIMENSION) == dimension, found)

    return Lookup(column, dates)


def run_checks(df: DataFrame, suite: Suite, measured_at) -> DataFrame:
    """Measure a suite against a table; one measurement row per binding.

    ``measured_at`` is a timestamp value or column expression, the same for all rows.
    """
    at = wall_clock(measured_at)
    parts: list[DataFrame] = []
    partials = suite.partials(df)
    if partials is not None:
        shared = [i for i, b in enumerate(suite.bindings) if not isinstance(b.check, KeyedCheck)]
        parts.append(suite.rows_of(suite.measure(partials, at), shared, at))
    counted = suite.counted_keys()
    if len(counted) > 1:
        totals = key_totals(suite.key_counts(suite.key_rows(df, counted)))
        parts.append(suite.rows_of(suite.measure_keys(totals, counted), counted, at))
    for i, _ in suite.of_family(KeyedCheck):
        if len(counted) < 2 or i not in counted:
            parts.append(suite.rows_of(suite.measure_keyed(df, i), [i], at))
    return reduce(DataFrame.unionByName, parts)


def measure_partials(partials: DataFrame, suite: Suite, measured_at) -> DataFrame:
    """Measurement rows of the row and series checks from stored per-date partial aggregates."""
    at = wall_clock(measured_at)
    shared = [i for i, b in enumerate(suite.bindings) if not isinstance(b.check, KeyedCheck)]
    return suite.rows_of(suite.measure(partials, at), shared, at)


def run_checks_by_date(
    df: DataFrame, suite: Suite, date: str, measured_at: Column
) -> DataFrame:
    """Measure the row checks of a suite against every date's rows, as a history of daily runs.

    ``measured_at`` is an expression over the column ``__date``. One pass, one row per date and check.
    """
    row_checks = suite.of_family(RowCheck)
    if len(row_checks) != len(suite.bindings):
        raise ValueError("only row checks can be measured date by date in one pass")
    at = wall_clock(measured_at)
    kept = [b.check.partial_of(b).alias(f"r{i}") for i, b in row_checks]
    per_date = df.groupBy(F.col(date).cast("date").alias(DATE)).agg(*kept)
    wide = per_date.select(
        DATE, *(b.check.finished(F.col(f"r{i}"), b, at).alias(f"m{i}") for i, b in row_checks)
    )
    return suite.rows_of(wide, [i for i, _ in row_checks], at)

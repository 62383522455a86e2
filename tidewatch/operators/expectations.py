"""Build-time expectations on a table: columns without NULLs, columns with a closed set of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# table -> (columns without NULLs, column -> accepted values)
Expectations = Mapping[str, tuple[Sequence[str], Mapping[str, Sequence[str]]]]


def expect_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """NULL rows per column, all columns in one pass: ``column_name, failing_rows``."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)))
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failing_rows"))
            for i, c in enumerate(columns)
        )
    )
    return counts.select(F.inline(rows))


def expect_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Every non-NULL value outside the list with its number of rows: ``value_field, n_records``."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def failures(*results: DataFrame) -> DataFrame:
    """``failing_rows`` results of several tables in one frame."""
    return reduce(DataFrame.unionByName, results)


class ExpectationError(Exception):
    """A table was built that isn't as expected."""


class Watch:
    """Counts what violates expectations while tables are built, without another pass.

    ``watch(name, df)`` gives ``df`` back, to be written; the counts are there once it is. Place it after
    the last shuffle of what is written: Spark counts the tasks of that stage once each, also when
    executors are lost.
    """

    def __init__(self, expectations: Expectations):
        self.expectations = expectations
        self.observations: dict[str, Observation] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        counts = [
            F.count_if(failing).alias(f"n{i}") for i, (_, _, failing) in enumerate(self._rules(name))
        ]
        if not counts:
            return df
        self.observations[name] = Observation()
        return df.observe(self.observations[name], *counts)

    def _rules(self, name: str) -> list:
        not_null, accepted = self.expectations.get(name, ((), {}))
        return [(c, "not_null", F.col(c).isNull()) for c in not_null] + [
            (c, "accepted_values", ~F.col(c).isin(*values)) for c, values in accepted.items()
        ]

    def rows(self) -> list[tuple[str, str, str, int]]:
        """(table, column, expectation, failing rows) of all tables built so far."""
        out = []
        for name, observation in self.observations.items():
            counts = observation.get
            out += [(name, c, kind, counts[f"n{i}"]) for i, (c, kind, _) in enumerate(self._rules(name))]
        return out

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.rows(), "table_name string, column_name string, expectation string, failing_rows long"
        )

    def require(self) -> None:
        """Fail the build if an expectation is violated."""
        failed = [r for r in self.rows() if r[3]]
        if failed:
            raise ExpectationError("; ".join(f"{t}.{c} {kind}: {n} rows" for t, c, kind, n in failed))

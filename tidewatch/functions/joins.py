"""Joins where NULL keys match each other, as they do in grouping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` of both frames; the result has the left side's keys once."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys)
    )
    return left.join(renamed, same, how).drop(*(f"__right_{k}" for k in keys))

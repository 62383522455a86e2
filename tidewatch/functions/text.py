"""Text column helpers: number text, names, templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(\w+)\}")


def num_text(x: Column) -> Column:
    """A number as people write it: whole numbers without ``.0``, no exponent, no trailing zeros."""
    x = x.cast("double")
    fixed = F.regexp_replace(F.format_string("%.8f", x), r"\.?0+$", "")
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when((x == F.floor(x)) & (F.abs(x) < 1e18), F.floor(x).cast("string"))
        .when((F.abs(x) >= 1e-7) & (F.abs(x) < 1e18), fixed)
        .otherwise(x.cast("string"))
    )


def short_name(qualified: Column) -> Column:
    """``A.B.SOME_CHECK`` -> ``some_check``."""
    return F.lower(F.substring_index(qualified, ".", -1))


def fill_template(template: str, slots: dict[str, Column]) -> Column:
    """Put columns into the ``{name}`` slots of a text. Any NULL slot makes the whole text NULL."""
    pieces = []
    for i, piece in enumerate(_SLOT.split(template)):
        if i % 2:
            pieces.append(slots[piece])
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def sql_text(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def template_sql(template: str, slots: dict[str, str]) -> str:
    """Like ``fill_template``, as a SQL expression over SQL expressions."""
    pieces = _SLOT.split(template)
    return "concat(" + ", ".join(
        slots[piece] if i % 2 else sql_text(piece) for i, piece in enumerate(pieces)
    ) + ")"

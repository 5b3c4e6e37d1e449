"""Reusable Column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number in text, matching pandas ``to_numeric``: an
# optional sign, digits with an optional point or a leading point, an optional
# exponent, or inf / infinity.  ``nan`` is a number to pandas but yields a missing
# value, so it is left out.
NUMERIC_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default=0.0) -> Column:
    """``num / den``, ``default`` when the denominator is zero or null (ANSI-safe)."""
    return F.coalesce(F.try_divide(col_of(num).cast("double"), col_of(den).cast("double")), F.lit(default))


def parse_number(c) -> Column:
    """Text to double the way ``to_numeric(errors='coerce')`` does; NaN becomes null."""
    t = F.trim(col_of(c).cast("string"))
    v = F.when(t.rlike(NUMERIC_TEXT), t.try_cast("double"))
    return F.when(~F.isnan(v), v)


def nan_to_null(c) -> Column:
    v = col_of(c)
    return F.when(~F.isnan(v), v)


def r6(c) -> Column:
    """Reported floats are rounded to 6 places so two engines agree on them."""
    return F.round(col_of(c).cast("double"), 6)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")

"""Small reusable expressions; all are built-ins, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to [lo, hi]; null stays null (``greatest``/``least`` alone would skip it)."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def ratio_or_zero(num: str | Column, den: str | Column) -> Column:
    return F.coalesce(F.try_divide(_col(num), _col(den)), F.lit(0.0))


def half_up(c: str | Column, digits: int) -> Column:
    """Round for comparison: a nudge far below the last digit settles exact halves the same way everywhere."""
    return F.round(_col(c) + F.lit(10.0 ** -(digits + 3)), digits)


def hash_key(key: str | Column, seed: int | str) -> Column:
    """Reproducible pseudo-random text key of a row: the same in any engine that has md5."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit(f"|{seed}")))


def hash_fraction(hexkey: Column) -> Column:
    """First 32 bits of a hex key as a number in [0, 1); monotone in the key's text order."""
    return F.conv(F.substring(hexkey, 1, 8), 16, 10).cast("double") / 4294967296.0


def hash_uniform(key: str | Column, seed: int | str) -> Column:
    return hash_fraction(hash_key(key, seed))


def fixed(c: str | Column, digits: int) -> Column:
    """Number as text with fixed digits, halves decided by the exact binary value (``printf`` in Java decides by the shortest decimal)."""
    return F.call_function("format_number", _col(c).cast("double"), F.lit("0." + "0" * digits if digits else "0"))


def num(x: float) -> str:
    """A number as a double literal of an SQL expression."""
    return f"({float(x)!r}D)"


def linear_bin(x: str, lo: str, hi: str, bins: int) -> Column:
    """Index of the equal-width bin of column x between columns lo and hi: closed left, last bin closed on both sides.

    Counts the inner edges at or below x instead of flooring a ratio, so values on an edge fall
    where explicit edges put them.
    """
    step = f"(({hi} - {lo}) / {num(bins)})"
    return F.expr(" + ".join(f"CAST({x} >= {lo} + {num(i)} * {step} AS INT)" for i in range(1, bins)))


def scalar_of(df: DataFrame) -> Column:
    """A one-row one-column DataFrame as a scalar subquery: no collect, no cross join."""
    return df.scalar()


def strip_prefix(c: str | Column, prefix: str) -> Column:
    return F.when(F.startswith(_col(c), F.lit(prefix)), F.substring(_col(c), F.lit(len(prefix) + 1), F.length(_col(c)))).otherwise(_col(c))


def slug(c: str | Column) -> Column:
    return F.translate(F.lower(_col(c)), " ", "_")


def title(c: str | Column) -> Column:
    return F.initcap(F.translate(_col(c), "_", " "))


def missing(c: Column) -> Column:
    """Null, or NaN in a column of floating-point numbers."""
    return c.isNull() | (F.typeof(c).isin("double", "float") & F.coalesce(c.cast("string") == "NaN", F.lit(False)))

"""Text -> typed column expressions for the staging layer.

All functions return ``Column`` expressions built from built-in Spark
functions, so they stay inside whole-stage codegen.  The lenient forms use
``try_cast`` / ``try_to_*``: bad text becomes NULL (and is counted by
``audit.audit_rejects``) instead of failing the job, which ANSI mode would
otherwise do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """Trim spaces; an empty result becomes NULL (T7 + T8)."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def to_int(c: ColumnOrName, dtype: str = "int", on_error: str = "null") -> Column:
    """Text -> integer (T1).  ``on_error="fail"`` raises on bad text."""
    t = F.trim(col(c))
    if on_error == "fail":
        return t.cast(dtype)
    return t.try_cast(dtype)


def opt_int(c: ColumnOrName, dtype: str = "int") -> Column:
    """Optional text -> integer; blank -> NULL."""
    return blank_to_null(c).try_cast(dtype)


def int_or_zero(c: ColumnOrName, dtype: str = "int") -> Column:
    """Blank or NULL text -> 0."""
    return F.coalesce(opt_int(c, dtype), F.lit(0).cast(dtype))


def nonneg_int(c: ColumnOrName, dtype: str = "int") -> Column:
    """Text -> integer >= 0; blank, NULL and negative -> 0 (T4)."""
    zero = F.lit(0).cast(dtype)
    return F.greatest(F.coalesce(opt_int(c, dtype), zero), zero)


def to_decimal(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Text -> DECIMAL(p, s), rounding half up; overflow -> NULL (T5)."""
    return blank_to_null(c).try_cast(f"decimal({precision},{scale})")


def nonneg_decimal(c: ColumnOrName, precision: int = 18, scale: int = 4) -> Column:
    """Text -> DECIMAL(p, s) >= 0; blank, NULL and negative -> 0."""
    dt = f"decimal({precision},{scale})"
    zero = F.lit(0).cast(dt)
    return F.coalesce(F.greatest(blank_to_null(c).try_cast(dt), zero), zero)


def to_flag(c: ColumnOrName) -> Column:
    """'0'/'1' text -> BOOLEAN, only 1 is true; blank or bad text -> NULL."""
    return opt_int(c) == F.lit(1)


def recode(c: ColumnOrName, code: str, value: str) -> Column:
    """Trimmed text; the code ``code`` is replaced by ``value``."""
    t = F.trim(col(c))
    return F.when(t == F.lit(code), F.lit(value)).otherwise(t)


def online_city(c: ColumnOrName) -> Column:
    """City '9999' marks online customers and stores."""
    return recode(c, "9999", "Online")


def nan_to_null(c: ColumnOrName) -> Column:
    """Float NaN -> NULL (T25); other types pass through unchanged."""
    c = col(c)
    nan = F.typeof(c).isin("float", "double") & (c.cast("string") == "NaN")
    return F.when(F.coalesce(~nan, F.lit(True)), c)


def fmt2(c: ColumnOrName) -> Column:
    """Number -> text with exactly two decimals."""
    return col(c).cast("decimal(18,2)").cast("string")


def changed(a: ColumnOrName, b: ColumnOrName, collation: str | None = None) -> Column:
    """NULL-tolerant inequality: NULL and '' count as equal.

    ``collation`` (e.g. ``"UNICODE_CI_AI_RTRIM"``) makes the comparison
    case, accent and trailing-space insensitive.
    """
    x = F.coalesce(col(a), F.lit(""))
    y = F.coalesce(col(b), F.lit(""))
    if collation:
        x = F.collate(x, collation)
        y = F.collate(y, collation)
    return x != y

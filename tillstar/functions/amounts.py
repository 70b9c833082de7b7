"""Receipt-line money arithmetic (T27), all in DECIMAL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import ColumnOrName, col


def discount_amount(unit_price: ColumnOrName, quantity: ColumnOrName,
                    pct: ColumnOrName) -> Column:
    """price * qty * pct / 100, rounded half up to cents.

    Multiplying by the decimal 0.01 keeps the value a DECIMAL; dividing by
    the integer 100 would not in every engine.
    """
    raw = col(unit_price) * col(quantity) * col(pct).cast("int") * F.lit(0.01).cast("decimal(3,2)")
    return F.round(raw, 2).cast("decimal(18,2)")


def line_total(unit_price: ColumnOrName, quantity: ColumnOrName,
               discount_abs: ColumnOrName) -> Column:
    """max(0, price * qty - discount), rounded half up to cents."""
    gross = col(unit_price) * col(quantity) - F.coalesce(col(discount_abs), F.lit(0))
    return F.greatest(F.round(gross, 2), F.lit(0)).cast("decimal(18,2)")

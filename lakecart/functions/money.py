"""Money arithmetic: binary doubles rounded half-up to two places after the arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakecart.functions._util import to_col


def round_money(c: Column | str) -> Column:
    return F.round(to_col(c), 2)


def gross_margin(unit_price: Column | str, cost: Column | str, quantity: Column | str) -> Column:
    """round((unit_price − cost) × quantity, 2); null when the product is unknown."""
    return round_money((to_col(unit_price) - to_col(cost)) * to_col(quantity))

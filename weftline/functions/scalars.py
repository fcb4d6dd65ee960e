"""Scalar expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def money(c: Column | str) -> Column:
    """Exact amount with two decimals; a sum of these does not depend on row order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def rate(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(4,2)")


def net_price(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    return money(price) * (F.lit(1) - rate(discount))


def total(c: Column) -> Column:
    """Sum of exact amounts, given back as a double."""
    return F.sum(c).cast("double")


def quantity_sum(c: str = "l_quantity") -> Column:
    return F.sum(F.col(c).cast("long"))

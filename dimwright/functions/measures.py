"""Fact measures in decimal arithmetic (no floating point)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total_before_tax(qty: Column, price: Column) -> Column:
    """Quantity * UnitPrice as decimal(18,2)."""
    return (qty * price).cast("decimal(18,2)")


def total_after_tax(qty: Column, price: Column, tax_rate: Column) -> Column:
    """Quantity * UnitPrice * (1 + TaxRate / 100), half-up to decimal(18,2)."""
    return (qty * price * (F.lit(1) + tax_rate * F.lit("0.01").cast("decimal(2,2)"))).cast("decimal(18,2)")

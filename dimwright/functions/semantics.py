"""SQL-semantics helpers (text comparison, null handling, integer and decimal
averages, percentages).  All are built-in Column expressions, so they stay in
whole-stage codegen; no Python runs per row.

Rounding is half away from zero everywhere, computed exactly on integers so it
never depends on a binary floating-point intermediate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- text -------------------------------------------------------------------
def eq_ci(c: str | Column, value: str) -> Column:
    """Case-insensitive equality, as under a case-insensitive collation."""
    return F.lower(col(c)) == F.lit(value.lower())


def like_ci(c: str | Column, pattern: str) -> Column:
    """Case-insensitive LIKE."""
    return col(c).ilike(pattern)


def contains_literal(c: str | Column, text: str) -> Column:
    """LIKE '%text%' where text holds no wildcard (so '?' is literal)."""
    return col(c).contains(text)


def is_null_or_blank(c: str | Column) -> Column:
    """``c IS NULL OR c = ' '`` with trailing blanks ignored in the comparison."""
    return col(c).isNull() | (F.rtrim(col(c)) == F.lit(""))


def key_form(c: Column, is_text: bool = True) -> Column:
    """The form in which business keys and tracked text are compared: case and
    trailing blanks do not count.  Values that are not text compare as they are."""
    return F.lower(F.rtrim(c)) if is_text else c


# -- null logic -------------------------------------------------------------
def keep_unless(predicate: Column) -> Column:
    """Filter for ``DELETE ... WHERE predicate``: rows where it is unknown survive."""
    return ~F.coalesce(predicate, F.lit(False))


def differs(a: Column, b: Column, null_safe: bool = True) -> Column:
    """Change test between two values; the legacy ``<>`` treats null as no change."""
    if null_safe:
        return ~a.eqNullSafe(b)
    return F.coalesce(a != b, F.lit(False))


def any_changed(pairs: list[tuple[Column, Column]], null_safe: bool = True) -> Column:
    return reduce(lambda x, y: x | y, [differs(a, b, null_safe) for a, b in pairs])


# -- exact rounding ----------------------------------------------------------
def half_up_quotient(num: Column, den: Column) -> Column:
    """round-half-away-from-zero(num / den) for integer columns, den > 0, exactly.

    ``div`` divides integers exactly, so no double rounding is involved.
    """
    sign = F.when(num < 0, F.lit(-1)).otherwise(F.lit(1))
    twice = F.abs(num) * 2 + den
    d2 = den * 2
    return F.call_function("div", twice, d2).cast("long") * sign


def cents_of(amount: Column) -> Column:
    """``amount.cast("decimal(18,2)")`` in whole cents as BIGINT.

    Nearly all amounts are the double next to some whole number of cents, which a product and a quotient
    tell; only the others go through decimal text.
    """
    nearest = F.rint(amount * 100)
    exact = (nearest / 100 == amount) & (F.abs(amount) < F.lit(1e12))
    return F.when(exact, nearest.cast("long")).otherwise((amount.cast("decimal(18,2)") * 100).cast("long"))


def round_ratio(num: Column, den: Column, digits: int, precision: int = 18) -> Column:
    """num / den rounded half-up to ``digits`` decimals, as decimal(precision, digits).

    ``num`` and ``den`` are integer-valued (counts, sums of whole numbers or of
    unscaled decimals).  Null when ``den`` is zero or null.
    """
    scale = 10 ** digits
    q = half_up_quotient(num.cast("long") * scale, den.cast("long"))
    out = (q.cast("decimal(38,0)") / F.lit(scale)).cast(f"decimal({precision},{digits})")
    return F.when(den.cast("long") > 0, out)


def int_avg(c: str) -> Column:
    """AVG over an INT column with integer result (truncated), as in T-SQL."""
    return F.expr(f"sum(`{c}`) div count(`{c}`)").cast("int")


def avg_rounded(c: Column, digits: int, input_scale: int = 0) -> Column:
    """ROUND(AVG(c), digits) for a decimal column with ``input_scale`` decimals, exact."""
    unscaled = (c * (10 ** input_scale)).cast("long")
    return round_ratio(F.sum(unscaled), F.count(c) * (10 ** input_scale), digits)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """ROUND(part / whole * 100, digits) in decimal, exact."""
    return round_ratio(part.cast("long") * 100, whole, digits)


def to_whole_decimal(c: str | Column) -> Column:
    """CAST(x AS DECIMAL): T-SQL's bare DECIMAL is (18,0); rounds half-up."""
    return col(c).cast("decimal(18,0)")

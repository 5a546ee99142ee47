"""Misspelt values by deletion neighbourhoods.

Two texts that differ by at most ``e`` inserted, deleted or replaced characters
have a text in common that is left when up to ``e`` characters are removed from each.
So every distinct spelling is joined by the hashes of its shortened forms - no
spelling is compared with all others - and Levenshtein's distance confirms the pairs.
Frequency decides: a spelling is corrected to a near one that is at least
``ratio`` times as frequent, which the join also asks for, so rare spellings
meet frequent ones only.

Work grows with the number of distinct spellings and the square of their length
(for two edits), not with rows: these are counted first, map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.operators.keys import materialize


def _without_one(text: str) -> str:
    """SQL: all forms of ``text`` without one of its characters."""
    return (f"transform(sequence(1, greatest(length({text}), 1)), "
            f"i -> concat(left({text}, i - 1), substring({text}, i + 1)))")


def deletions(column: str, edits: int) -> Column:
    """Array of the distinct forms of a text column with up to ``edits`` (1 or 2) characters removed."""
    forms = f"concat(array({column}), {_without_one(column)}"
    if edits == 2:
        forms += f", flatten(transform({_without_one(column)}, t -> {_without_one('t').replace('i ->', 'j ->').replace('i - 1', 'j - 1').replace('i + 1', 'j + 1')}))"
    elif edits != 1:
        raise ValueError("one or two edits")
    return F.expr(f"array_distinct({forms}))")


def misspellings(df: DataFrame, column: str, edits: int = 2, ratio: int = 4, min_length: int = 5) -> DataFrame:
    """(SPELLING, N, CORRECTED, CORRECTED_N, EDITS) of the values of ``column`` that seem misspelt.

    Of the near spellings that are frequent enough the most frequent counts, then the one
    with fewest edits, then the smallest.  Spellings shorter than ``min_length`` are
    neither corrected nor corrections; nulls are left out.
    """
    counted = df.where(F.length(column) >= min_length).groupBy(F.col(column).alias("s")).agg(
        F.count(F.lit(1)).alias("n"))
    counted = materialize(counted)
    forms = counted.select("s", "n", F.explode(deletions("s", edits)).alias("form")).select(
        "s", "n", F.xxhash64("form").alias("form"))
    other = forms.select(F.col("s").alias("t"), F.col("n").alias("m"), "form")
    met = forms.join(other, "form").where((F.col("m") >= ratio * F.col("n")) & (F.col("s") != F.col("t")))
    near = met.select("s", "n", "t", "m").distinct().withColumn("e", F.levenshtein("s", "t")).where(F.col("e") <= edits)
    best = near.groupBy("s", "n").agg(F.min(F.struct((-F.col("m")).alias("m"), "e", "t")).alias("b"))
    return best.select(
        F.col("s").alias("SPELLING"), F.col("n").alias("N"), F.col("b.t").alias("CORRECTED"),
        (-F.col("b.m")).alias("CORRECTED_N"), F.col("b.e").alias("EDITS"))


def corrected(df: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``df`` with the misspelt values of ``column`` replaced by the corrections of ``misspellings``."""
    fixes = found.select(F.col("SPELLING").alias(column), F.col("CORRECTED").alias("_corrected"))
    joined = df.join(fixes, column, "left")
    return joined.withColumn(column, F.coalesce("_corrected", column)).select(*df.columns)

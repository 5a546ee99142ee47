"""Digests of source rows: what changed since the last run, without moving the rows.

A member's digest has two 64-bit hashes of its business key and two of the set of
its rows (a source may list a member several times).  Values are hashed in the
form in which the dimensions compare them, with nulls told apart from texts.  Comparing two
snapshots of digests shuffles some 40 bytes a member, whatever its columns hold;
only members that differ go into the dimension's join.  Two states of one
member are mistaken for each other with a probability of about 2^-128.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.operators.scd import _form, _match_names, with_match_keys

KEY_DIGEST = ["_k1", "_k2"]
_ROW_DIGEST = ["_r1", "_r2"]
NEW, CHANGED, GONE = "new", "changed", "gone"


def _told(c: Column) -> Column:
    """Text of a value; the hash would skip a null."""
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))


def _hashes(columns: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *[_told(c) for c in columns]) for seed in (1, 2)]


def with_key_digest(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the digest of the compared form of its business key."""
    forms = [_form(df, k) for k in keys]
    return df.withColumns(dict(zip(KEY_DIGEST, _hashes(forms))))


def member_digests(df: DataFrame, keys: list[str], attrs: list[str], as_compared: bool = True) -> DataFrame:
    """(_k1, _k2, _r1, _r2, _rows): one row per business key; rows with a null key are left out.

    With ``as_compared`` case and trailing blanks of ``attrs`` do not count (type 2);
    without it ``attrs`` and the spelling of the keys count as they are (type 1).
    """
    named = with_match_keys(df.dropna(subset=keys), keys)
    values = [_form(named, c) for c in attrs] if as_compared else [named[c] for c in (*attrs, *keys)]
    key = _hashes([named[m] for m in _match_names(keys)])
    rows = named.select(*[h.alias(n) for h, n in zip([*key, *_hashes(values)], [*KEY_DIGEST, *_ROW_DIGEST])])
    sets = [F.bit_xor(c).alias(c) for c in _ROW_DIGEST]
    return rows.distinct().groupBy(*KEY_DIGEST).agg(*sets, F.count(F.lit(1)).alias("_rows"))


def digest_diff(before: DataFrame, now: DataFrame) -> DataFrame:
    """(_k1, _k2, CHANGE) of the members that are new, changed or gone between two snapshots."""
    state = lambda df, side: df.select(
        *KEY_DIGEST, F.struct(*_ROW_DIGEST, "_rows").alias(side))
    both = state(before, "_before").join(state(now, "_now"), KEY_DIGEST, "full_outer")
    change = (F.when(F.col("_before").isNull(), F.lit(NEW)).when(F.col("_now").isNull(), F.lit(GONE))
              .when(F.col("_before") != F.col("_now"), F.lit(CHANGED)))
    return both.withColumn("CHANGE", change).where("CHANGE is not null").select(*KEY_DIGEST, "CHANGE")


def split_by_members(df: DataFrame, keys: list[str], members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose business key is among ``members (_k1, _k2)``, and the others."""
    named = with_key_digest(df, keys)
    wanted = members.select(*KEY_DIGEST)
    parts: list[Callable] = [lambda how=how: named.join(wanted, KEY_DIGEST, how).select(*df.columns)
                             for how in ("left_semi", "left_anti")]
    return parts[0](), parts[1]()

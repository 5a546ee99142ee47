"""Slowly changing dimensions.

``scd1`` - type 1: one row per business key; known keys keep their surrogate key,
new keys get the next ones.

``scd2`` - type 2 with ``StartDate``/``EndDate`` validity.  One full outer join
of the de-duplicated stage with the *open* dimension rows classifies every
business key in a single shuffle:

    stage only                 -> new          : new key, valid from start_date
    both, tracked cols differ  -> changed      : open row closed at end_date + new version
    both, equal                -> unchanged    : open row carried as is
    dimension only             -> missing      : open row closed at end_date
    closed (historic) rows     -> passed through untouched

A run may repeat its own date.  An open row that began on ``start_date`` has no
earlier day to be closed on, so it is settled in place:

    both, tracked cols differ  -> corrected    : new values under the same key and dates
    dimension only             -> withdrawn    : the version is dropped

A run older than the newest version is refused (``BackdatedRunError``): closing
or opening versions there would contradict later ones.

Business keys and tracked text compare without regard to case and trailing
blanks; stage rows with a null business key are left out.  New and changed rows
are numbered together, ordered by business key, after the highest key in use.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.functions.semantics import any_changed, key_form
from dimwright.operators.keys import max_key, with_dense_keys

NEW, CHANGED, UNCHANGED, MISSING = "new", "changed", "unchanged", "missing"
CORRECTED, WITHDRAWN = "corrected", "withdrawn"


class BackdatedRunError(ValueError):
    """Raised when a type-2 run is older than the newest version of its dimension."""


def _form(df: DataFrame, name: str) -> Column:
    return key_form(df[name], isinstance(df.schema[name].dataType, T.StringType))


def _match_names(keys: list[str]) -> list[str]:
    return [f"_m{i}" for i in range(len(keys))]


def with_match_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the compared form of each business key column in ``_m0``, ``_m1``, ..."""
    return df.withColumns({m: _form(df, k) for m, k in zip(_match_names(keys), keys)})


def dedupe_by_key(stage: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """One row per business key, plus its compared form; among duplicates the
    smallest (attributes, key spelling) wins (deterministic, and row-consistent
    because the struct is taken whole).  Rows with a null key are left out."""
    named = stage.select(*keys, *attrs).dropna(subset=keys)
    matched = with_match_keys(named, keys)
    names = _match_names(keys)
    pick = F.min(F.struct(*[F.col(c) for c in (*attrs, *keys)])).alias("_row")
    return matched.groupBy(*names).agg(pick).select(*names, *[F.col(f"_row.{c}").alias(c) for c in (*keys, *attrs)])


# -- type 1 --------------------------------------------------------------------
def scd1(
    stage: DataFrame,
    dim: DataFrame,
    keys: list[str],
    attrs: list[str],
    key_col: str,
    stage_to_dim: dict[str, str] | None = None,
) -> DataFrame:
    """Preload rows for a type-1 dimension.

    ``stage_to_dim`` renames stage columns to dimension names first.  Returns
    ``key_col`` + keys + attrs for every business key present in the stage:
    existing ones reuse their key, new ones are numbered after the highest key.
    """
    if stage_to_dim:
        stage = stage.select(*[F.col(s).alias(d) for s, d in stage_to_dim.items()])
    staged = dedupe_by_key(stage, keys, attrs)
    names = _match_names(keys)
    known = with_match_keys(dim.select(key_col, *keys), keys).select(key_col, *names)
    matched = staged.join(known, names, "inner")
    fresh = staged.join(known, names, "left_anti")
    numbered = with_dense_keys(fresh, keys, key_col, base=max_key(dim, key_col))
    cols = [key_col, *keys, *attrs]
    return matched.select(*cols).unionByName(numbered.select(*cols))


# -- type 2 --------------------------------------------------------------------
def _lit_date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(str(d)).cast("date")


def is_backdated(dim: DataFrame, start) -> bool:
    """Whether some version begins after ``start`` or was valid on it and has ended."""
    return bool(dim.agg(F.max(_newer_than(_lit_date(start))).alias("later")).first()["later"])


def _newer_than(day: Column) -> Column:
    return (F.col("StartDate") > day) | (F.col("EndDate") >= day)


def scd2_classify(
    stage: DataFrame,
    dim: DataFrame,
    key: str,
    tracked: list[str],
    start_date,
    stage_to_dim: dict[str, str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Full outer join of stage and open rows with a ``_status`` column.

    Output columns: key (the stage's spelling, else the dimension's), ``s_<col>``
    (stage values), ``d_<col>`` (open dimension row), ``_status``.
    """
    if stage_to_dim:
        stage = stage.select(*[F.col(s).alias(d) for s, d in stage_to_dim.items()])
    staged = dedupe_by_key(stage, [key], tracked).select(
        "_m0", F.lit(True).alias("_in_stage"), F.col(key).alias(f"s_{key}"),
        *[F.col(c).alias(f"s_{c}") for c in tracked]
    )
    open_rows = with_match_keys(dim.filter(F.col("EndDate").isNull()), [key]).select(
        "_m0", F.lit(True).alias("_in_dim"), *[F.col(c).alias(f"d_{c}") for c in dim.columns]
    )
    j = staged.join(open_rows, ["_m0"], "full_outer")
    changed = any_changed([(_form(j, f"s_{c}"), _form(j, f"d_{c}")) for c in tracked], null_safe)
    same_day = F.col("d_StartDate") == _lit_date(start_date)
    status = (
        F.when(F.col("_in_dim").isNull(), F.lit(NEW))
        .when(F.col("_in_stage").isNull(), F.when(same_day, F.lit(WITHDRAWN)).otherwise(F.lit(MISSING)))
        .when(changed, F.when(same_day, F.lit(CORRECTED)).otherwise(F.lit(CHANGED)))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.withColumn("_status", status).withColumn(key, F.coalesce(f"s_{key}", f"d_{key}"))


def scd2_branches(
    stage: DataFrame,
    dim: DataFrame,
    key: str,
    tracked: list[str],
    key_col: str,
    start_date,
    end_date,
    stage_to_dim: dict[str, str] | None = None,
    null_safe: bool = True,
    report: dict | None = None,
    highest: int = 0,
) -> dict[str, DataFrame]:
    """The disjoint preload branches plus the untouched history.

    New keys follow the highest one in ``dim``, or ``highest`` if that is higher.
    If ``report`` is given, ``report["changed"]`` tells whether the version
    differs from ``dim`` at all, read from the already written classification.

    ``changed``  new versions of changed rows          (new keys)
    ``closed``   open rows: superseded ones closed, unchanged ones carried, same-day ones corrected
    ``new``      first versions of new business keys   (new keys)
    ``expired``  open rows missing from the stage, closed
    ``history``  closed rows, untouched
    """
    # What must be known of the dimension beforehand, in one job.
    known = dim.agg(F.max(_newer_than(_lit_date(start_date))).alias("later"), F.max(key_col).alias("key")).first()
    if known["later"]:
        raise BackdatedRunError(f"{key_col}: a version is newer than {start_date}")
    out_cols = [key_col, key, *tracked, "StartDate", "EndDate"]
    start, end = _lit_date(start_date), _lit_date(end_date)
    # The classification (the one shuffle join) is written once, by the key
    # numbering: new versions sort first, so their positions are dense.
    old = ~F.col("_status").isin(NEW, CHANGED)
    cls = with_dense_keys(
        scd2_classify(stage, dim, key, tracked, start_date, stage_to_dim, null_safe).withColumn("_old", old),
        ["_old", key], "_new_key", base=max(known["key"] or 0, highest))
    if report is not None:
        report["changed"] = not cls.filter(F.col("_status") != UNCHANGED).isEmpty()

    def versions(status: str) -> DataFrame:
        return cls.filter(F.col("_status") == status).select(
            F.col("_new_key").alias(key_col), key, *[F.col(f"s_{c}").alias(c) for c in tracked],
            start.alias("StartDate"), F.lit(None).cast("date").alias("EndDate"))

    def old_rows(statuses: list[str]) -> DataFrame:
        corrected = F.col("_status") == CORRECTED
        return cls.filter(F.col("_status").isin(*statuses)).select(
            F.col(f"d_{key_col}").alias(key_col),
            F.when(corrected, F.col(f"s_{key}")).otherwise(F.col(f"d_{key}")).alias(key),
            *[F.when(corrected, F.col(f"s_{c}")).otherwise(F.col(f"d_{c}")).alias(c) for c in tracked],
            F.col("d_StartDate").alias("StartDate"),
            F.when(F.col("_status").isin(CHANGED, MISSING), end).cast("date").alias("EndDate"),
        )

    return {
        "changed": versions(CHANGED).select(*out_cols),
        "closed": old_rows([CHANGED, UNCHANGED, CORRECTED]),
        "new": versions(NEW).select(*out_cols),
        "expired": old_rows([MISSING]),
        "history": dim.filter(F.col("EndDate").isNotNull()).select(*out_cols),
    }


def scd2(
    stage: DataFrame,
    dim: DataFrame,
    key: str,
    tracked: list[str],
    key_col: str,
    start_date,
    end_date,
    stage_to_dim: dict[str, str] | None = None,
    null_safe: bool = True,
    report: dict | None = None,
    highest: int = 0,
) -> DataFrame:
    """The whole next version of a type-2 dimension (every row, old and new)."""
    parts = scd2_branches(
        stage, dim, key, tracked, key_col, start_date, end_date, stage_to_dim, null_safe, report, highest)
    return reduce(DataFrame.unionByName, parts.values())

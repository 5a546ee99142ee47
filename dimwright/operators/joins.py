"""Join helpers: null-key spreading, validity-interval (as-of) lookups, lateral split.

No join here carries a size check or a hint of its own (one-row aggregates
aside): Spark's statistics and AQE choose broadcast or shuffle by bytes, and
the same plan shape holds at every size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.functions.semantics import key_form
from dimwright.operators.keys import materialize


def _fingerprint(keys: list[Column]) -> Column:
    return F.xxhash64(*[k.cast("string") for k in keys])


def _spread(keys: list[Column], by: list[Column]) -> Column:
    """A second join column: the keys' hash, or for rows with a null key a hash of ``by``.

    Rows with a null key match nothing, but a shuffled join would still send all
    of them to one task; with this column they scatter.
    """
    null_key = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    return F.when(null_key, F.xxhash64(*by)).otherwise(_fingerprint(keys))


def left_join_spread(left: DataFrame, right: DataFrame, on: str, by: str) -> DataFrame:
    """``left LEFT JOIN right`` on a column that is null in many rows of ``left``; those scatter by ``by``."""
    a = left.withColumn("_spread", _spread([left[on]], [left[by]]))
    b = right.withColumn("_spread", _fingerprint([right[on]]))
    return a.join(b, [on, "_spread"], "left").drop("_spread")


def _text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _scattering(facts: DataFrame, but: list[str]) -> list[Column]:
    """Columns whose hash scatters rows: a few that are no text, which is costly to hash; else all but the keys."""
    plain = [f.name for f in facts.schema.fields if f.name not in but and not isinstance(f.dataType, T.StringType)]
    return [facts[c] for c in plain[:4] or [c for c in facts.columns if c not in but] or facts.columns]


def _lookup_join(facts: DataFrame, d: DataFrame, fact_keys: list[str], n_keys: int, extra: list[Column],
                 how: str) -> DataFrame:
    """Join ``facts`` to the prepared lookup ``d`` (key columns ``_dk0``...) in one pass over ``facts``."""
    fact_side = [key_form(F.col(k), _text(facts, k)) for k in fact_keys]
    dim_side = [key_form(F.col(f"_dk{i}"), _text(d, f"_dk{i}")) for i in range(n_keys)]
    f = facts.withColumn("_spread", _spread(fact_side, _scattering(facts, fact_keys)))
    d = d.withColumn("_dspread", _fingerprint(dim_side))
    cond = [a == b for a, b in zip(fact_side, dim_side)] + [F.col("_spread") == F.col("_dspread")] + extra
    return f.join(d, cond, how).drop("_spread", "_dspread", *[f"_dk{i}" for i in range(n_keys)])


def left_join_small_preserved(small: DataFrame, big: DataFrame, on: str | list[str]) -> DataFrame:
    """``small LEFT JOIN big`` where the preserved side is usually the small one
    (e.g. one day of orders against all order lines).

    An outer hash join can only build its non-preserved side.  So the distinct
    join keys of ``small`` are written and ``big`` is semi-joined against
    them first: the written keys' size is known in bytes, so Spark
    broadcasts them when they are few - ``big`` then streams past without a
    shuffle - and shuffles both sides when they are many.
    """
    keys = [on] if isinstance(on, str) else list(on)
    wanted = materialize(small.select(*keys).distinct())
    return small.join(big.join(wanted, keys, "left_semi"), keys, "left")


def single_row_broadcast(one_row: DataFrame) -> DataFrame:
    """Broadcast an ungrouped aggregate: it has exactly one row by construction."""
    return F.broadcast(one_row)


def valid_on(start: Column, end: Column, on: Column) -> Column:
    """StartDate <= on <= coalesce(EndDate, 9999-12-31) - inclusive validity."""
    return (start <= on) & (on <= F.coalesce(end, F.lit("9999-12-31").cast("date")))


def asof_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: list[str],
    dim_keys: list[str],
    date_col: str,
    take: dict[str, str],
    how: str = "left",
    first_covers_earlier: bool = False,
) -> DataFrame:
    """Attach dimension columns valid on ``facts[date_col]``.

    Equi-join on the business key (case and trailing blanks ignored) plus an
    inclusive ``StartDate``/``EndDate`` residual, so a key with several versions
    matches exactly one of them.  ``take`` maps dimension column -> output name.
    With ``first_covers_earlier`` the first version of each key also covers
    the dates before its ``StartDate`` (late or backfilled facts).
    """
    d = dim.select(
        *[F.col(k).alias(f"_dk{i}") for i, k in enumerate(dim_keys)],
        F.col("StartDate").alias("_ds"),
        F.col("EndDate").alias("_de"),
        *[F.col(c).alias(o) for c, o in take.items()],
    )
    if first_covers_earlier:
        d = _covering_earlier(d, len(dim_keys))
    valid = valid_on(F.col("_ds"), F.col("_de"), F.col(date_col))
    return _lookup_join(facts, d, fact_keys, len(dim_keys), [valid], how).drop("_ds", "_de")


def _covering_earlier(d: DataFrame, n_keys: int) -> DataFrame:
    """The prepared lookup ``d`` with the first version of each key valid from the first day of all."""
    # One key's versions: bounded by how often that member changed.
    per_key = Window.partitionBy(*[key_form(F.col(f"_dk{i}"), _text(d, f"_dk{i}")) for i in range(n_keys)])
    first = F.col("_ds") == F.min("_ds").over(per_key)
    return d.withColumn("_ds", F.when(first, F.lit("0001-01-01").cast("date")).otherwise(F.col("_ds")))


def versions_by_id(
    names: DataFrame,
    id_col: str,
    name_col: str,
    dim: DataFrame,
    dim_key: str,
    take: list[str],
    first_covers_earlier: bool = False,
) -> DataFrame:
    """All versions of the members of ``names (id_col, name_col)``: id_col, StartDate, EndDate and ``take``.

    For ``asof_lookup`` of many facts that carry an id: each name meets its versions once, instead of
    once per fact.  Members without a version are left out.
    """
    d = dim.select(F.col(dim_key).alias("_dk0"), F.col("StartDate").alias("_ds"), F.col("EndDate").alias("_de"), *take)
    if first_covers_earlier:
        d = _covering_earlier(d, 1)
    met = _lookup_join(names, d, [name_col], 1, [], "inner")
    return met.select(id_col, F.col("_ds").alias("StartDate"), F.col("_de").alias("EndDate"), *take)


def asof_carry(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: list[str],
    dim_keys: list[str],
    date_col: str,
    take: dict[str, str],
    block_days: int = 32,
) -> DataFrame:
    """``asof_lookup`` (left) for members with very many versions: carry-forward instead of a join.

    A join meets every fact with all versions of its member before the dates are
    compared.  Here versions and facts of a member are put in date order together
    and each fact takes the version before it, if that is still valid.  A
    member's time is cut into blocks of ``block_days``; a block also gets the version
    with which it is entered, the last one of the earlier blocks, found among one
    row per member and block.  So a hot member spreads over as many tasks as it has
    blocks, and no row is multiplied.  Facts without a key scatter and get nulls.

    Versions of a member must not overlap, as ``scd2`` writes them.
    """
    n = len(fact_keys)
    keys = [f"_k{i}" for i in range(n)]
    block = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / block_days)
    versions = dim.select(
        *[key_form(F.col(k), _text(dim, k)).alias(m) for k, m in zip(dim_keys, keys)],
        F.col("StartDate").alias("_day"),
        F.struct(F.col("EndDate").alias("end"), *[F.col(c).alias(o) for c, o in take.items()]).alias("_version"),
    ).dropna(subset=[*keys, "_day"]).withColumn("_block", block(F.col("_day")))
    rows = facts.select(
        *[key_form(F.col(k), _text(facts, k)).alias(m) for k, m in zip(fact_keys, keys)],
        F.col(date_col).alias("_day"), F.struct(*facts.columns).alias("_fact"),
        *[facts[c].alias(f"_s{i}") for i, c in enumerate(facts.columns)])
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in (*keys, "_day")])
    scatter = F.pmod(F.xxhash64(*[f"_s{i}" for i in range(len(facts.columns))]), F.lit(1 << 16))
    rows = rows.withColumn("_block", block(F.col("_day"))).withColumn("_salt", F.when(no_key, scatter).otherwise(0))
    rows = rows.select(*keys, "_day", "_block", "_salt", "_fact")
    # The version with which a block is entered: carried over the blocks of a member.
    last = versions.groupBy(*keys, "_block").agg(F.max_by("_version", "_day").alias("_version"))
    wanted = rows.where(F.col("_salt") == 0).select(*keys, "_block").distinct()
    by_block = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entered = last.join(wanted.withColumn("_wanted", F.lit(True)), [*keys, "_block"], "full_outer")
    entered = entered.withColumn("_entry", F.last("_version", ignorenulls=True).over(by_block))
    entered = entered.where("_wanted and _entry is not null").select(
        *keys, F.lit(None).cast("date").alias("_day"), "_block", F.col("_entry").alias("_version"))
    blank = facts.schema
    no_fact = F.lit(None).cast(T.StructType([T.StructField(f.name, f.dataType) for f in blank.fields]))
    zero = F.lit(0).cast("long")
    # Nulls sort first: the entry, then by date, versions before the facts of their day.
    events = (
        versions.unionByName(entered).select(*keys, "_day", "_block", zero.alias("_salt"), zero.alias("_kind"),
                                             "_version", no_fact.alias("_fact"))
        .unionByName(rows.select(
            *keys, "_day", "_block", F.col("_salt").cast("long").alias("_salt"), F.lit(1).cast("long").alias("_kind"),
            F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), "_fact"))
    )
    in_order = Window.partitionBy(*keys, "_block", "_salt").orderBy("_day", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = events.withColumn("_at", F.last("_version", ignorenulls=True).over(in_order)).where("_kind = 1")
    valid = ~no_key & (F.col("_day") <= F.coalesce(F.col("_at.end"), F.lit("9999-12-31").cast("date")))
    return carried.select("_fact.*", *[F.when(valid, F.col(f"_at.{o}")).alias(o) for o in take.values()])


def key_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: list[str],
    dim_keys: list[str],
    take: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Attach columns of a dimension with one row per business key (type 1)."""
    d = dim.select(
        *[F.col(k).alias(f"_dk{i}") for i, k in enumerate(dim_keys)],
        *[F.col(c).alias(o) for c, o in take.items()],
    )
    return _lookup_join(facts, d, fact_keys, len(dim_keys), [], how)


def lateral_split(df: DataFrame, column: str, sep: str, out: str | None = None) -> DataFrame:
    """CROSS APPLY string_split: one row per part; null input gives no row,
    '' gives one blank part, parts are not trimmed."""
    import re

    return df.withColumn(out or column, F.explode(F.split(F.col(column), re.escape(sep))))

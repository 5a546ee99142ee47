"""Type-2 history of many days in one pass, and of days that arrive late.

``scd2_change_log`` - a log tells, per member and day, its values from that day on
(or that it is gone).  Gaps and islands over the log give every version: a row
begins one if the member was absent before or a tracked value differs from the row
before it; the next beginning or leave ends it.  That is one shuffle by
business key, however many days the log has, instead of one run per day.  A
member has at most one row a day after de-duplication, so the largest group is
bounded by the number of days.

``scd2_insert`` - the state of all members on a day older than the newest version.
It holds until the day before the next day that was observed.  Versions that reach
into this span are shortened or split, the span takes the values told, and versions
that touch and agree become one.  So the days of a history may be loaded in any
order: it is always the one that loading them in order gives.  Surrogate keys
are never changed where facts need not be: a version keeps the key of its
earliest part; the later part of a split version gets a new key, as two spans
cannot share one.  ``moved`` lists the spans whose key is another now.

Business keys and tracked text compare without regard to case and trailing blanks;
rows with a null business key or day are left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.functions.semantics import any_changed
from dimwright.operators.keys import materialize, max_key, with_dense_keys
from dimwright.operators.scd import BackdatedRunError, _form, dedupe_by_key, with_match_keys

_OPEN = "9999-12-31"


def _date(d: dt.date | str) -> Column:
    return F.lit(str(d)).cast("date")


def _newest_day(dim: DataFrame) -> dt.date | None:
    """The last day on which a version begins or ends."""
    return dim.agg(F.max(F.greatest("StartDate", "EndDate")).alias("d")).first()["d"]


def _differs_from(df: DataFrame, tracked: list[str], before: Window) -> Column:
    return any_changed([(_form(df, c), F.lag(_form(df, c)).over(before)) for c in tracked])


def scd2_change_log(
    log: DataFrame,
    dim: DataFrame,
    key: str,
    tracked: list[str],
    key_col: str,
    day_col: str = "LogDate",
    gone_col: str = "Gone",
) -> DataFrame:
    """The whole dimension after all days of ``log (key, tracked..., day_col, gone_col)``.

    Equals successive ``scd2`` runs, one per day of the log, each with the state
    of all members on that day, surrogate keys included: versions are
    numbered by first day and business key after the highest key in use.  Of several rows
    of a member and day a present one counts before a leave, then the smallest.
    Every day must be later than all days of ``dim``.
    """
    first = log.agg(F.min(day_col).alias("d")).first()["d"]
    newest = _newest_day(dim)
    if first is not None and newest is not None and first <= newest:
        raise BackdatedRunError(f"{key_col}: the log begins on {first}, the dimension reaches {newest}")
    told = with_match_keys(log.dropna(subset=[key, day_col]), [key])
    row = F.struct(F.coalesce(F.col(gone_col), F.lit(False)).alias("gone"), *[F.col(c) for c in (*tracked, key)])
    told = told.groupBy("_m0", F.col(day_col).alias("_day")).agg(F.min(row).alias("_row")).select(
        "_m0", "_day", F.col("_row.gone").alias("_gone"), *[F.col(f"_row.{c}").alias(c) for c in (key, *tracked)],
        F.lit(None).cast("long").alias("_key"))
    open_rows = with_match_keys(dim.filter(F.col("EndDate").isNull()), [key]).select(
        "_m0", F.col("StartDate").alias("_day"), F.lit(False).alias("_gone"), key, *tracked,
        F.col(key_col).cast("long").alias("_key"))
    events = told.unionByName(open_rows)
    by_day = Window.partitionBy("_m0").orderBy("_day")
    was_gone = F.coalesce(F.lag("_gone").over(by_day), F.lit(True))  # absent before the first row
    turn = F.when(F.col("_gone"), ~was_gone).otherwise(was_gone | _differs_from(events, tracked, by_day))
    turns = events.withColumn("_turn", turn).where("_turn")
    versions = turns.withColumn("EndDate", F.date_sub(F.lead("_day").over(by_day), 1)).where(~F.col("_gone"))
    versions = versions.select("_key", key, *tracked, F.col("_day").alias("StartDate"), "EndDate",
                               F.col("_key").isNotNull().alias("_old"))
    # New versions sort first, so their positions are dense.
    numbered = with_dense_keys(versions, ["_old", "StartDate", key], "_new_key", base=max_key(dim, key_col))
    out = [key_col, key, *tracked, "StartDate", "EndDate"]
    return numbered.withColumn(key_col, F.coalesce("_key", "_new_key")).select(*out).unionByName(
        dim.filter(F.col("EndDate").isNotNull()).select(*out))


def scd2_insert(
    stage: DataFrame,
    dim: DataFrame,
    key: str,
    tracked: list[str],
    key_col: str,
    day: dt.date,
    until: dt.date,
) -> tuple[DataFrame, DataFrame]:
    """The dimension with the members of ``stage`` from ``day`` to the day before ``until``, and ``moved``.

    ``until`` is the next day that was observed, so the state told for ``day`` holds until then.
    ``moved`` has (key_col, NewKey, FirstDay, LastDay): outside that span, days on which a version's key
    is another now (LastDay is null if it is still open).
    """
    if until <= day:
        raise ValueError(f"the next observed day {until} is not after {day}")
    last = until - dt.timedelta(days=1)
    lo, hi, nxt = _date(day), _date(last), _date(until)
    old = with_match_keys(dim, [key])
    end = F.coalesce("EndDate", _date(_OPEN))
    starts_before, ends_after = F.col("StartDate") < lo, end > hi
    no_key, no_date = F.lit(None).cast("long"), F.lit(None).cast("date")

    def piece(from_: Column, to: Column, usable: Column) -> Column:
        return F.struct(from_.alias("_from"), to.alias("_to"), usable.alias("_usable"))

    own = F.col(key_col).cast("long")
    left = piece(F.col("StartDate"), F.when(end < lo, F.col("EndDate")).otherwise(F.date_sub(lo, 1)), own)
    # The later part of a split version cannot keep the key that the earlier part has.
    right = piece(F.greatest("StartDate", nxt), F.col("EndDate"), F.when(starts_before, no_key).otherwise(own))
    parts = F.filter(F.array(F.when(starts_before, left), F.when(ends_after, right)), lambda p: p.isNotNull())
    kept = old.select("_m0", key, *tracked, own.alias("_key"), F.explode(parts).alias("_p")).select(
        "_m0", key, *tracked, "_key", "_p.*")
    told = dedupe_by_key(stage, [key], tracked).select(
        "_m0", key, *tracked, no_key.alias("_key"), lo.alias("_from"), hi.alias("_to"), no_key.alias("_usable"))
    pieces = kept.unionByName(told)
    by_day = Window.partitionBy("_m0").orderBy("_from")
    touches = F.coalesce(F.date_add(F.lag("_to").over(by_day), 1) == F.col("_from"), F.lit(False))
    begins = (~touches | _differs_from(pieces, tracked, by_day)).cast("int")
    pieces = pieces.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(by_day))
    pieces = materialize(pieces.drop("_begins"))
    usable = F.min(F.when(F.col("_usable").isNotNull(), F.struct("_from", F.col("_usable").alias("k"))))
    islands = pieces.groupBy("_m0", "_island").agg(
        usable["k"].alias("_kept"), F.min("_from").alias("StartDate"),
        F.max(F.coalesce("_to", _date(_OPEN))).alias("_end"),
        F.min_by(F.struct(key, *tracked), "_from").alias("_row"))
    versions = islands.select(
        "_m0", "_island", "_kept", *[F.col(f"_row.{c}").alias(c) for c in (key, *tracked)], "StartDate",
        F.when(F.col("_end") == _date(_OPEN), no_date).otherwise(F.col("_end")).alias("EndDate"),
        F.col("_kept").isNotNull().alias("_old"))
    numbered = with_dense_keys(versions, ["_old", "StartDate", key], "_new_key", base=max_key(dim, key_col))
    after = numbered.withColumn(key_col, F.coalesce("_kept", "_new_key"))
    now = after.select("_m0", "_island", F.col(key_col).alias("NewKey"))
    moved = pieces.where("_key is not null").join(now, ["_m0", "_island"]).where("_key <> NewKey").select(
        F.col("_key").alias(key_col), "NewKey", F.col("_from").alias("FirstDay"), F.col("_to").alias("LastDay"))
    return after.select(key_col, key, *tracked, "StartDate", "EndDate"), moved


def rekey(facts: DataFrame, moved: DataFrame, key_col: str, date_col: str = "DateKey") -> DataFrame:
    """``facts`` with ``key_col`` replaced where ``moved`` has a span for the key and the fact's date (yyyymmdd)."""
    as_key = lambda d: F.date_format(d, "yyyyMMdd").cast("int")
    spans = moved.select(
        F.col(key_col).alias("_moved"), "NewKey", as_key("FirstDay").alias("_lo"),
        F.coalesce(as_key("LastDay"), F.lit(99991231)).alias("_hi"))
    on = (F.col(key_col) == F.col("_moved")) & F.col(date_col).between(F.col("_lo"), F.col("_hi"))
    joined = facts.join(spans, on, "left")
    return joined.withColumn(key_col, F.coalesce("NewKey", key_col)).select(*facts.columns)

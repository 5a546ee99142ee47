"""Loading: upsert by key, versioned snapshots, date-partitioned fact writes,
and the empty-extract guard.

Parquet tables have no UPDATE/DELETE/MERGE, and a table must never be
overwritten while it is being read.  So a dimension load writes the complete
next version to a new folder and only then records it as current in a small
manifest; a failed job leaves the previous version current.  A fact load writes
its dates to a new run folder, partitioned by ``DateKey``; for every date the
newest listed run that covers it counts, so re-running a date replaces that
date's rows - also when the date is empty now.  One manifest append makes
the dimensions and the fact of a run current together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimwright.functions.dates import date_key
from dimwright.session import delete_path, path_exists, work_path


# Fixed value from the reference: the message of its empty-extract error.
EMPTY_EXTRACT_MESSAGE = "No records found. Check with source system."


class EmptyExtractError(RuntimeError):
    """Raised when an extract wrote no rows."""


def upsert_by_key(current: DataFrame, preload: DataFrame, key_col: str) -> DataFrame:
    """Rows of ``current`` whose key is not in ``preload``, plus all of ``preload``.

    (``DELETE d FROM d JOIN p ON key`` followed by ``INSERT ... SELECT p``.)
    """
    kept = current.join(preload.select(key_col), key_col, "left_anti")
    return kept.unionByName(preload.select(*current.columns))


def adds_rows(preload: DataFrame, current: DataFrame) -> bool:
    """True when ``preload`` holds a row that is not already in ``current``
    (null-safe comparison of every column).  If False, upserting ``preload``
    into ``current`` would change nothing, so the write can be skipped.

    One anti join; it stops at the first row found (limit 1).
    """
    cur = current.select(*[current[c].alias(f"_c_{c}") for c in preload.columns])
    cond = [preload[c].eqNullSafe(cur[f"_c_{c}"]) for c in preload.columns]
    return not preload.join(cur, cond, "left_anti").isEmpty()


def replaced_rows(current: DataFrame, preload: DataFrame, key_col: str) -> DataFrame:
    """Rows of ``current`` that an upsert of ``preload`` replaces."""
    return current.join(preload.select(key_col), key_col, "left_semi")


def write_guarded(df: DataFrame, path: str, name: str = "extract", mode: str = "overwrite") -> int:
    """Write ``df`` and raise ``EmptyExtractError`` when it had no rows.

    The row count is observed during the write itself (no second pass).
    """
    obs = Observation(f"rows_{name}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    rows = obs.get["rows"]
    if rows == 0:
        raise EmptyExtractError(f"{name}: {EMPTY_EXTRACT_MESSAGE}")
    return rows


FACT = "fact_orders"
#: Manifest rows that tell on which day the members were observed (no table of their own).
MEMBER_DAYS = "member_days"
_MANIFEST = "table string, version int, first_key int, last_key int"


class Mart:
    """A folder of versioned dimension snapshots plus a date-partitioned fact.

    Layout::

        <root>/<table>/v=<n>/part-*.parquet               one folder per published version
        <root>/fact_orders/run=<n>/DateKey=<yyyymmdd>/    one folder per fact load
        <root>/_manifest/                                 (table, version, dates covered), appended on publish

    One writer at a time: a second one that picks the same number fails, as no
    folder is ever written twice.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        """Open the mart at ``root``, or start a new one in a fresh folder."""
        self.spark = spark
        self.root = (root or work_path(spark, "mart")).rstrip("/")
        self._rows: list = []
        if root is not None:
            self._load_manifest()

    def _load_manifest(self) -> None:
        """Read the manifest if there is one; a damaged one is an error, never an empty mart."""
        if path_exists(self.spark, f"{self.root}/_manifest"):
            # One row per published table and run: metadata, not data.
            self._rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_manifest").collect()

    @property
    def _versions(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for r in self._rows:
            out[r["table"]] = max(out.get(r["table"], 0), int(r["version"]))
        return out

    def has(self, table: str) -> bool:
        return table in self._versions

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._path(table, self._versions[table]))

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/{'run' if table == FACT else 'v'}={version}"

    def _next(self, table: str) -> int:
        """The next number whose folder does not exist (a failed run may have left some)."""
        n = self._versions.get(table, 0) + 1
        while path_exists(self.spark, self._path(table, n)):
            n += 1
        return n

    # -- writing: folders first, then one manifest append -----------------------
    def write_versions(self, tables: dict[str, DataFrame]) -> list[tuple]:
        """Write the complete next version of each table; returns the manifest rows that would list them."""
        versions = {t: self._next(t) for t in tables}

        def write(t: str) -> None:
            tables[t].write.mode("error").parquet(self._path(t, versions[t]))

        # Independent writes, submitted from parallel threads.
        with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
            list(pool.map(write, tables))
        return [(t, v, None, None) for t, v in versions.items()]

    def read_written(self, rows: list[tuple]) -> dict[str, DataFrame]:
        """The versions of ``write_versions``, listed or not."""
        return {t: self.spark.read.parquet(self._path(t, v)) for t, v, _, _ in rows}

    def write_run(self, fact: DataFrame, dates: list[tuple[int, int]] | None = None) -> tuple[list[tuple], int]:
        """Write a fact load covering the date-key ranges ``dates`` (by default the dates it holds).

        Returns its manifest rows and its row count; rows and dates are observed during the write itself,
        so ``fact`` is computed once.
        """
        run = self._next(FACT)
        obs = Observation(f"fact_{run}")
        told = [F.count(F.lit(1)).alias("rows")]
        if dates is None:  # at most one number per calendar day
            told.append(F.collect_set("DateKey").alias("days"))
        # Rebalance by date: rows of a date go to the same task (one file per
        # small date), AQE merges small partitions and splits any date larger
        # than its advisory size over several tasks, so a hot date does not
        # land in one task.  Unlike a range partitioning it needs no sampling pass.
        (
            fact.hint("rebalance", "DateKey").observe(obs, *told)
            .write.mode("error").partitionBy("DateKey").parquet(self._path(FACT, run))
        )
        if dates is None:
            dates = date_ranges(sorted(obs.get["days"]))
        return [(FACT, run, a, b) for a, b in dates], int(obs.get["rows"])

    def commit(self, rows: list[tuple]) -> None:
        """List the written folders, all at once: one file, appended to the manifest."""
        if rows:
            listed = self.spark.createDataFrame(rows, _MANIFEST)
            listed.coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")
            self._rows = [*self._rows, *listed.collect()]  # the rows just made here

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        """Write the complete next version of ``table``, then make it current."""
        return self.publish_many({table: df})[table]

    def publish_many(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write the next version of several tables, then make them current together."""
        self._load_manifest()
        rows = self.write_versions(tables)
        self.commit(rows)
        return self.read_written(rows)

    def upsert(self, table: str, preload: DataFrame, key_col: str) -> DataFrame:
        """Publish ``current`` upserted with ``preload``; no new version when
        the preload adds nothing (e.g. re-running dates already loaded)."""
        after = self.upserted(table, preload, key_col)
        return self.read(table) if after is None else self.publish(table, after)

    def upserted(self, table: str, preload: DataFrame, key_col: str) -> DataFrame | None:
        """The table after the upsert, or None if that would change nothing."""
        if not self.has(table):
            return preload
        current = self.read(table)
        if not adds_rows(preload.select(*current.columns), current):
            return None
        return upsert_by_key(current, preload, key_col)

    def prune(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions of each table, and fact loads that no date uses any more.
        Returns the number of folders deleted."""
        current = {r["run"] for r in self.fact_index().select("run").distinct().collect()} if self.has(FACT) else set()
        gone = []
        for r in self._rows:
            t, v = r["table"], int(r["version"])
            old = v not in current if t == FACT else v <= self._versions[t] - keep
            path = self._path(t, v)
            if old and path not in gone and path_exists(self.spark, path):
                gone.append(path)
        for path in gone:
            delete_path(self.spark, path)
        return len(gone)

    # -- days on which members were observed ---------------------------------
    def observed_on(self, day: dt.date) -> list[tuple]:
        """The manifest row that tells so."""
        return [(MEMBER_DAYS, self._versions.get(MEMBER_DAYS, 0) + 1, as_key(day), as_key(day))]

    def next_observed(self, day: dt.date) -> dt.date | None:
        """The next day after ``day`` on which members were observed (a load's first day, where none is told)."""
        told = [r for r in self._rows if r["table"] == MEMBER_DAYS] or [r for r in self._rows if r["table"] == FACT]
        return min((as_date(r["first_key"]) for r in told if r["first_key"] > as_key(day)), default=None)

    # -- fact --------------------------------------------------------------
    @property
    def fact_path(self) -> str:
        return f"{self.root}/{FACT}"

    def write_fact(self, fact: DataFrame) -> int:
        """Load ``fact``, replacing the dates it holds (idempotent per date); returns the rows written."""
        self._load_manifest()
        rows, written = self.write_run(fact)
        self.commit(rows)
        return written

    def fact_index(self, first_key: int | None = None, last_key: int | None = None) -> DataFrame:
        """(run, DateKey): the newest listed load of each loaded date, optionally of a range of date keys.

        One row per calendar day, by one aggregation over the manifest as far as this object has read it.
        """
        listed = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_manifest").where(
            (F.col("table") == FACT) & (F.col("version") <= self._versions.get(FACT, 0))
            & (F.col("last_key") >= (0 if first_key is None else first_key))
            & (F.col("first_key") <= (99991231 if last_key is None else last_key)))
        day = lambda key: F.to_date(F.col(key).cast("string"), "yyyyMMdd")
        days = listed.select("version", F.explode(F.sequence(day("first_key"), day("last_key"))).alias("day"))
        newest = days.groupBy(date_key(F.col("day")).alias("DateKey")).agg(F.max("version").alias("run"))
        return _within(newest, first_key, last_key).select("run", "DateKey")

    def read_fact(self, first_key: int | None = None, last_key: int | None = None) -> DataFrame:
        """The current rows of the fact, optionally of a range of date keys.

        A join with the index on the two partition columns: Spark prunes the folders by it at run time, so those
        that no date uses are not read, however many loads there are.  The index is broadcast; it has at most one
        row per calendar day.
        """
        rows = _within(self.spark.read.parquet(self.fact_path), first_key, last_key)
        current = rows.join(F.broadcast(self.fact_index(first_key, last_key)), ["run", "DateKey"])
        return current.select(*[c for c in rows.columns if c != "run"])


    # -- what a load of the fact leaves beside it ------------------------------
    def written_load(self, loads: list[tuple]) -> DataFrame:
        """The rows of the load just written."""
        return self.spark.read.parquet(self._path(FACT, loads[0][1]))

    def write_parts(self, name: str, loads: list[tuple], part: DataFrame) -> list[tuple]:
        """Write ``part`` (with its DateKey) under the number of the load just written; returns the manifest row."""
        run = loads[0][1]
        part.write.mode("error").parquet(f"{self.root}/{name}/run={run}")
        return [(name, run, None, None)]

    def read_parts(self, name: str) -> DataFrame:
        """The parts of current rows: of each date those of its newest load."""
        index = self.fact_index()
        kept = {r["version"] for r in self._rows if r["table"] == name}
        missing = [r["run"] for r in index.select("run").distinct().collect() if r["run"] not in kept]
        if missing:
            raise ValueError(f"loads without {name}: {sorted(missing)[:10]}")
        parts = self.spark.read.parquet(f"{self.root}/{name}")
        return parts.join(F.broadcast(index), ["run", "DateKey"]).drop("run")  # one row per day


def _within(rows: DataFrame, first_key: int | None, last_key: int | None) -> DataFrame:
    if first_key is not None:
        rows = rows.where(F.col("DateKey") >= first_key)
    return rows if last_key is None else rows.where(F.col("DateKey") <= last_key)


def date_ranges(keys: list[int]) -> list[tuple[int, int]]:
    """Ranges of neighbouring days among sorted date keys."""
    ranges: list[tuple[int, int]] = []
    for k in keys:
        if ranges and as_date(k) - as_date(ranges[-1][1]) == dt.timedelta(days=1):
            ranges[-1] = (ranges[-1][0], k)
        else:
            ranges.append((k, k))
    return ranges


def as_date(key: int) -> dt.date:
    return dt.datetime.strptime(str(key), "%Y%m%d").date()


def as_key(day: dt.date) -> int:
    return int(f"{day:%Y%m%d}")


def date_range(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]

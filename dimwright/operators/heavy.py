"""The most frequent groups, without shuffling every group.

Each task keeps at most ``counters`` groups with a lower bound of their count: when
there are more, the next largest count is taken off all of them (Misra and Gries),
and what was taken off adds up to the task's error.  Sketches merge by adding:
a group's count lies between its sum and its sum plus the total error, and a
group that no sketch holds has at most the total error.

If the total error is below the largest sum, only groups whose upper bound reaches
that sum can win; they alone are counted exactly.  Otherwise, or if there are too
many of them, nothing is proven and all groups are counted.  Either way the
result is exact, ties included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.operators import grouped
from dimwright.operators.keys import materialize

COUNTERS = 4096


class Sketch:
    """At most ``counters`` groups; ``error`` is the most by which a count may be too low."""

    def __init__(self, counters: int):
        self.counters, self.error, self.counts = counters, 0, Counter()

    def add(self, found: dict) -> None:
        self.counts.update(found)
        if len(self.counts) > 2 * self.counters:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > self.counters:
            off = sorted(self.counts.values(), reverse=True)[self.counters]
            self.error += off
            self.counts = Counter({k: n - off for k, n in self.counts.items() if n > off})


def _sketched(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(counters)
        for batch in batches:
            found = pc.value_counts(batch.column("group"))
            sketch.add(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist())))
        sketch.shrink()
        groups = [None, *sketch.counts]  # the row without a group tells the error
        yield pa.record_batch({"group": pa.array(groups, pa.string()),
                               "n": pa.array([sketch.error, *sketch.counts.values()], pa.int64())})

    return run


def busiest_groups(df: DataFrame, keys: list[str], alias: str, counters: int = COUNTERS) -> DataFrame:
    """The groups of ``keys`` with the most rows, ties included, and that number; all null-safe."""
    # Null key values are told apart from texts.
    group = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    sketch = materialize(
        df.select(group.alias("group")).mapInArrow(_sketched(counters), "group string, n long")
        .groupBy("group").agg(F.sum("n").alias("n")))
    known = sketch.agg(F.max(F.when(F.col("group").isNotNull(), F.col("n"))).alias("best"),
                       F.max(F.when(F.col("group").isNull(), F.col("n"))).alias("error")).first()
    best, error = known["best"] or 0, known["error"] or 0
    may_win = sketch.where(F.col("group").isNotNull() & (F.col("n") + error >= best)).select("group")
    rows = df
    if error < best and may_win.limit(counters + 1).count() <= counters:  # at most that many, so broadcast
        rows = df.withColumn("_group", group).join(
            F.broadcast(may_win.withColumnRenamed("group", "_group")), "_group", "left_semi")
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    return grouped.argmax_groups(counts, alias)

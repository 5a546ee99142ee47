"""Sharding by a Feistel permutation of global row numbers.

Rows get the global numbers 0 .. n-1 in the order of ``doc_id`` (then checksum
and size), independent of how the table is split into files.  A keyed Feistel
network permutes the numbers; shard and slot follow from the permuted number by
division, so both are computable for any row number without looking at others.
The law is ``rows``: shard sizes differ by at most one row.

The network works on pairs (left, right) with left < a, right < b, where
a = ceil(sqrt(n)) and b = ceil(n / a).  Each round adds a keyed hash of one half
to the other half, modulo its size, which can be undone, so it permutes
0 .. a*b-1.  Numbers that leave 0 .. n-1 are permuted again until they are back
(cycle walking).  As a*b - n < a, that concerns about one row in sqrt(n), and no
walk can be longer than a*b - n + 1 steps.

DataFrame and SQL operations only; texts never shuffle, only (doc_id, size,
checksum) do.

Defined cases: a null text has size 8 and checksum 0; null ids are numbered
last; rows equal in id, size and checksum have equal content, so which of
them gets which number does not matter; equal texts are treated as separate rows;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import LAST_ID, stored, text_of

#: Bytes counted for a row besides its text.
ROW_OVERHEAD = 8
ROUNDS = 4
#: Steps of a walk tried before the full bound on its length is used.
SHORT_WALK = 8


def row_numbers(rows: DataFrame, order_by: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` 0 .. n-1 in ``order_by`` order, and n.

    Range partitions are sorted and written once; a running sum over one count
    per partition gives each its first number.
    """
    ranged = stored(
        rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    firsts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    numbered = (
        ranged.withColumn("_part", part)
        .join(F.broadcast(firsts), "_part")  # one row per partition
        .withColumn("row_number", F.col("_first") + place).drop("_at", "_part", "_first")
    )
    return numbered, ranged.count()


def feistel(number: Column, n: int, seed: int) -> Column:
    """The permuted number of ``number`` in 0 .. n-1, for any fixed ``n`` and ``seed``."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def keyed(half: Column, round_: int, size: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(round_), half), F.lit(size))

    def step(x: Column) -> Column:
        left, right = F.call_function("div", x, F.lit(b)), F.pmod(x, F.lit(b))
        for i in range(ROUNDS):
            if i % 2:
                right = F.pmod(right + keyed(left, i, b), F.lit(b))
            else:
                left = F.pmod(left + keyed(right, i, a), F.lit(a))
        return (left * b + right).cast("long")

    def walk(x: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x, lambda at, _: F.when(at < n, at).otherwise(step(at)))

    once = step(number.cast("long"))
    short = walk(once, SHORT_WALK)
    return F.when(once < n, once).when(short < n, short).otherwise(walk(short, a * b - n + 1))


def shard_rows(docs: DataFrame, n_shards: int = 24, seed: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number) of every row."""
    text = text_of().cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_rank"),
        F.monotonically_increasing_id().alias("_tie"),  # lets many equal rows spread over ranges
    )
    numbered, n = row_numbers(rows, ["_rank", "text_crc32", "size", "_tie"])
    placed = numbered.withColumn("_to", feistel(F.col("row_number"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("_to", F.lit(n_shards)).cast("int").alias("shard"),
        F.call_function("div", F.col("_to"), F.lit(n_shards)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )

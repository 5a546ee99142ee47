"""Exact dedup by a stateful stream over a digest log.

1. *Digest log.*  One pass over the texts writes (digest, doc_id, locator) per
   row.  The locator says where the text can be read again: the input file where
   Spark knows it.  Texts themselves never enter the state.
2. *Keyed state.*  A Structured Streaming aggregation reads the log and keeps, per
   digest and without expiry, the largest identifier, its locator, and the number
   of rows.  The state lives on disk (RocksDB) with its checkpoint in the shared
   folder, so a lost executor resumes from it, and a later run over a grown log
   continues from it.  Counting starts map-side, so a text that fills a third of
   the table reaches its state partition as one row per task.
3. *Hits.*  Rows of a digest held by several rows are compared, on their full
   text, with the text of the row that stays.  Should two texts ever share a
   digest, the rows of that digest are grouped by the text itself instead.

DataFrame and SQL operations only.

Defined cases: null and empty texts are equal to each other; of rows that also
share the largest ``doc_id`` all are reported as kept (they are one document); a
null ``doc_id`` never wins over another, and a group of null ids only has a null
``keep_id``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.llm.common import shuffle_cleanup, stored, text_of
from dimwright.session import work_path

#: Disk-backed state; without preallocation a state partition's files take what they hold, not 4 MB each.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digest_log(docs: DataFrame, digest=sha256_of) -> DataFrame:
    """(digest, doc_id, locator) of every row."""
    return docs.select(
        digest(text_of()).alias("digest"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.input_file_name().alias("locator"),
    )


def update_state(spark: SparkSession, log_path: str, state_path: str) -> DataFrame:
    """Run the log's unread part through the keyed state; return the state of every digest.

    Output goes nowhere: the state itself is the result, read back as a table.
    """
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        seen = (
            spark.readStream.schema("digest string, doc_id long, locator string").parquet(log_path)
            .groupBy("digest")
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                 F.max_by("locator", "doc_id").alias("locator"))
        )
        query = (
            seen.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", state_path).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.format("statestore").load(state_path)


def _groups(state: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size, locator): the value struct holds the aggregates in the order of ``update_state``."""
    value = state.schema["value"].dataType.names
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value").getField(value[0]).alias("keep_id"),
        F.col("value").getField(value[1]).alias("group_size"),
        F.col("value").getField(value[2]).alias("locator"),
    )


def _unequal_digests(docs: DataFrame, log: DataFrame, groups: DataFrame, digest) -> DataFrame:
    """Digests whose rows do not all hold the same bytes.

    Only hits - rows of a digest seen more than once - bring their text.  They are
    picked by ``doc_id``, so no task gathers a large group, and smallest and
    largest text meet map-side before they shuffle by digest.
    """
    repeated = groups.where("group_size > 1").select("digest")
    hits = log.join(repeated, "digest").select(F.col("doc_id").alias("hit_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return (
        texts.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
        .groupBy(digest(F.col("text")).alias("digest"))
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where("low <> high").select("digest")
    )


def exact_duplicates(docs: DataFrame, digest=sha256_of) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, locator): one row per row of ``docs``.

    ``digest`` maps a text column to a string column; any function is right, as
    hits are checked on the text, and a strong one is fast.
    """
    spark = docs.sparkSession
    log_path, state_path = work_path(spark, "llm-digest-log"), work_path(spark, "llm-digest-state")
    with shuffle_cleanup(spark):
        digest_log(docs, digest).write.parquet(log_path)
    log = spark.read.schema("digest string, doc_id long, locator string").parquet(log_path)
    groups = stored(_groups(update_state(spark, log_path, state_path)), "digest-groups")
    unequal = stored(_unequal_digests(docs, log, groups, digest), "digest-unequal")

    columns = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")]
    out = log.drop("locator").join(groups, "digest").select(
        *columns, F.col("digest").alias("text_sha256"), "locator")
    by_sha = digest is sha256_of
    if by_sha and unequal.isEmpty():
        return out
    # Another digest, or unequal texts under one: group the rows concerned by their text.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), digest(text_of()).alias("digest"),
        sha256_of(text_of()).alias("text_sha256"), F.input_file_name().alias("locator"))
    mixed = rows.join(unequal, "digest", "left_semi")
    texts = mixed.groupBy("text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by("locator", "doc_id").alias("locator"))
    apart = mixed.drop("locator").join(texts, "text").select(*columns, "text_sha256", "locator")
    same = rows.drop("locator").join(unequal, "digest", "left_anti").join(groups, "digest").select(
        *columns, "text_sha256", "locator")
    return same.unionByName(apart)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text, with its columns: of those with the largest id, any one.

    Rows that repeat id and text, or have no id, are told apart by nothing but their place; only
    the texts of such groups are shuffled.
    """
    kept = stored(exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")), "exact-kept")
    sha = sha256_of(text_of())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (sha == F.col("_kept_sha"))
    stay = docs.join(kept, same, "left_semi")
    several = stored(
        kept.groupBy("_kept_sha").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("_kept_sha"),
        "exact-repeated", small=True)
    if several.isEmpty():
        return stay
    once = stay.join(several, sha == F.col("_kept_sha"), "left_anti")
    repeated = stay.join(several, sha == F.col("_kept_sha"), "left_semi").withColumn("_kept_sha", sha)
    return once.unionByName(repeated.dropDuplicates(["_kept_sha"]).drop("_kept_sha"))

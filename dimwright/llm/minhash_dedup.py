"""MinHash near-duplicate detection with tensored banding.

Documents are linked when the Jaccard similarity of their 5-word shingle sets is
at least 0.75; a document's component is everything reachable over links.

1. *Signatures.*  One pass over the texts gives each document its shingle count,
   a 128-bit digest of its word sequence, and two small collections of ``m``
   minhash values each.  Documents with one digest have one shingle set, so only
   one representative of each digest, a node with a number of its own, takes part in
   the search; so texts without an id stay apart.
2. *Tensored banding.*  Every pair (a value of the first collection, a value of
   the second) is a table key: ``m * m`` tables from only ``2 m`` minhashes.  A
   pair of similarity s shares a key with probability ``(1 - (1-s)^m)^2``; with
   m = 11 keys of two minhashes each that is 0.9998 at the threshold and more above it.
3. *Star candidates.*  In each bucket every member is paired with the bucket's
   smallest node only - never all pairs of a bucket.
4. *Verification* on the full shingle sets (64-bit shingle hashes), and connected
   components of the confirmed links.
5. *Remaining buckets.*  A bucket whose members now lie in one component can add
   nothing.  In the others, all pairs between different components are verified if
   the bucket has at most ``small_bucket`` members (a constant number per member).
   The members of larger ones are joined exactly: shingles rare among them come
   first in one global order, two sets at the threshold share a shingle of their
   prefixes in that order, and where they meet, and how many of their first shared
   shingles they have in common, bounds how much they can share.  Shingles held by one component only come before all others, so they never
   make a pair.  No member, bucket or pair that can be linked is left out.

Defined cases: a null or blank text has no shingle and links with nothing; fewer
than five words form one shingle; rows with equal word sequences are always
linked; rows with a null ``doc_id`` rank after every other id and are reported
with it, each text decided by itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import (
    LAST_ID, forget, gram_hashes, id_and_text, mix, pieces_of, stored, text_of, word_hashes,
)
from dimwright.llm.components import connected_components
from dimwright.llm.exact_dedup import sha256_of


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    #: Link when ``100 * |intersection| >= percent * |union|``.
    percent: int = 75
    #: Keys in each of the two collections; ``collection ** 2`` tables.
    collection: int = 11
    #: Minhash values joined into one collection key.
    width: int = 2
    #: Buckets up to this size are searched completely when they still hold several components.
    small_bucket: int = 8
    #: Shingles of a member that are compared before its whole set is (its first shared ones).
    firsts: int = 96
    #: A shingle with at least this share of all rows is told to every task (so there are at most ``1 / share``).
    hot_share: float = 1 / 4096
    seed: int = 20260


def _words(text: str) -> list[bytes]:
    """Words with A-Z lower-cased: bytes.lower() changes ASCII letters only."""
    return text.encode().lower().split()


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; all words as one if there are fewer."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(size, len(words))))


def _coefficients(p: Params) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(p.seed))
    n = 2 * p.collection * p.width
    return (rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 1 << 64, n, dtype=np.uint64))


def _collections(shingles: np.ndarray, mult: np.ndarray, flip: np.ndarray, p: Params) -> np.ndarray:
    """The 2 x ``collection`` keys of one document: ``width`` minhashes mixed into each."""
    lows = np.fromiter(
        (((shingles ^ x) * a).min() for a, x in zip(mult, flip)), dtype=np.uint64, count=len(mult)
    ).reshape(-1, p.width)
    key = lows[:, 0].copy()
    for j in range(1, p.width):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15)) + lows[:, j]
    return mix(key)


def _text_key() -> Column:
    """Tells rows without an id apart; the id alone names the others."""
    return F.when(F.col("doc_id").isNull(), sha256_of(text_of())).otherwise(F.lit(""))


def _digests(texts: list[list[bytes]]) -> dict[str, pa.Array]:
    """c1, c2: the halves of a 128-bit digest of each word sequence."""
    raw = b"".join(hashlib.blake2b(b" ".join(words), digest_size=16).digest() for words in texts)
    halves = np.frombuffer(raw, dtype="<i8").reshape(-1, 2)
    return {"c1": pa.array(halves[:, 0].copy()), "c2": pa.array(halves[:, 1].copy())}


def signatures(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, text_key, n_shingles, c1, c2, keys) of every document; c1, c2: digest of its word sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult, flip = _coefficients(p)
        for batch in pieces_of(batches):
            sizes, keys = [], []
            texts = [_words(t) for t in batch.column("text").to_pylist()]
            for words in texts:
                shingles = shingle_set(words, p.shingle)
                sizes.append(len(shingles))
                keys.append(_collections(shingles, mult, flip, p).view(np.int64) if words else None)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "n_shingles": pa.array(sizes, pa.int64()), **_digests(texts),
                "keys": pa.array(keys, pa.list_(pa.int64())),
            })

    return id_and_text(docs).withColumn("text_key", _text_key()).mapInArrow(
        run, "doc_id long, text_key string, n_shingles long, c1 long, c2 long, keys array<long>")


def shingle_sets(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, c1, c2, set): the whole shingle set of every document, as an array of 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            texts = [_words(t) for t in batch.column("text").to_pylist()]
            sets = [shingle_set(words, p.shingle).view(np.int64) for words in texts]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **_digests(texts),
                                   "set": pa.array(sets, pa.list_(pa.int64()))})

    return id_and_text(docs).mapInArrow(run, "doc_id long, c1 long, c2 long, set array<long>")


def buckets(reps: DataFrame) -> DataFrame:
    """(key, rep, n): every table key that two or more representatives share, with its members."""
    half = F.size("keys") / 2
    # Each row becomes a row per table: dealt out evenly first, as the files that it comes from are few.
    tasks = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        reps.repartition(tasks, "rep").select("rep", "n_shingles", F.slice("keys", 1, half.cast("int")).alias("first"),
                    F.slice("keys", half.cast("int") + 1, half.cast("int")).alias("second"))
        .select("rep", "n_shingles", "second", F.posexplode("first").alias("i", "u"))
        .select("rep", "n_shingles", "i", "u", F.posexplode("second").alias("j", "v"))
        .select(F.xxhash64("i", "j", "u", "v").alias("key"), "rep", "n_shingles")
    )
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return stored(rows.join(shared, "key"), "buckets")


def _verified(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole shingle sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 256):
            a, b = (batch.column(c) for c in ("set_a", "set_b"))
            ok = []
            for k in range(batch.num_rows):
                x, y = a[k].values.to_numpy(), b[k].values.to_numpy()
                # both are sorted as unsigned and free of repeats
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= p.percent * (len(x) + len(y) - common))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "linked": pa.array(ok, pa.bool_())})

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long, linked boolean")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _may_link(pairs: DataFrame, p: Params) -> DataFrame:
    """Sets whose sizes differ too much cannot reach the threshold."""
    return pairs.where(F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * p.percent)


def _star_pairs(members: DataFrame, p: Params) -> DataFrame:
    """Every bucket member with the bucket's smallest node."""
    centres = members.groupBy("key").agg(F.min("rep").alias("y"), F.min_by("n_shingles", "rep").alias("ny"))
    pairs = members.join(centres, "key").where("rep <> y").select(
        F.col("rep").alias("x"), F.col("n_shingles").alias("nx"), "y", "ny")
    return _ordered(_may_link(pairs, p)).distinct()


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component, of buckets that still hold several components."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    several = named.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return stored(named.join(several, "key", "left_semi"), "open", small=True)


def _pairs_in_small(open_: DataFrame, p: Params) -> DataFrame:
    """All pairs between different components of one bucket of at most ``small_bucket`` members."""
    small = open_.where(F.col("members") <= p.small_bucket)
    other = small.select("key", F.col("rep").alias("y"), F.col("n_shingles").alias("ny"), F.col("component").alias("cy"))
    pairs = small.join(other, "key").where("component <> cy and rep < y").select(
        F.col("rep").alias("x"), F.col("n_shingles").alias("nx"), "y", "ny")
    return _ordered(_may_link(pairs, p)).distinct()


def _prefixes(open_: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """(shingle, rep, n, component, pos, main, firsts, reach): the shingles of members of larger buckets at which a link can begin.

    Order: shingles of one component only, then the others by number of holders, the most common ones last.  Of two linked sets the first common
    shingle stands, in each set of size n, at a ``pos`` with n - pos >= percent * n / 100.  ``main``: the row is of the
    component with most rows of this shingle.  ``firsts``: the member's first shared shingles in that order, a
    bounded number, which with its own ones are its first ``reach`` places.
    """
    members = open_.where(F.col("members") > p.small_bucket).select("rep", F.col("n_shingles").alias("n"), "component")
    held = sets.join(members.distinct(), "rep").select("rep", "n", "component", F.explode("set").alias("shingle"))
    counts = stored(
        held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"),
                                    (F.min("component") != F.max("component")).alias("shared")), "shingle-counts")
    total = counts.agg(F.sum("holders").alias("n")).first()["n"] or 0
    hot = counts.where(F.col("holders") >= total * p.hot_share).select("shingle", "shared").collect()  # 1 / hot_share rows
    known = F.col("shingle").isin([r["shingle"] for r in hot])
    # No other shingle has more than that share of the rows, so its holders may meet in one task.
    holders = Window.partitionBy("shingle")
    rare = held.where(~known).select(
        "*", F.count(F.lit(1)).over(holders).alias("holders"), F.min("component").over(holders).alias("low"),
        F.max("component").over(holders).alias("high")).where("low <> high").drop("low", "high")
    common = held.where(F.col("shingle").isin([r["shingle"] for r in hot if r["shared"]])).withColumn(
        "holders", F.lit(LAST_ID))
    own = Window.partitionBy("rep")
    placed = stored(rare.unionByName(common).select(
        "shingle", "rep", "n", "component", F.row_number().over(own.orderBy("holders", "shingle")).alias("turn"),
        (F.col("n") - F.count(F.lit(1)).over(own)).alias("alone")).withColumn(
        "pos", F.col("alone") + F.col("turn") - 1), "placed")
    prefixes = placed.where((F.col("n") - F.col("pos")) * 100 >= F.col("n") * p.percent).drop("turn", "alone")
    firsts = placed.where(F.col("turn") <= p.firsts).groupBy("rep").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "shingle"))), lambda t: t["shingle"]).alias("firsts"),
        (F.max("pos") + 1).alias("reach"))
    rows = F.count(F.lit(1)).over(Window.partitionBy("shingle", "component"))
    ranked = prefixes.withColumn("rank", F.struct(rows.alias("rows"), F.col("component")))
    ranked = ranked.select(
        "*", F.max("rank").over(holders)["component"].alias("most"), F.min("component").over(holders).alias("low"),
        F.max("component").over(holders).alias("high")).where("low <> high")
    marked = ranked.withColumn("main", F.col("component") == F.col("most")).drop("rank", "most", "low", "high")
    out = stored(marked.join(firsts, "rep"), "prefixes")
    forget(counts)
    forget(placed)
    return out


def _pairs_in_large(open_: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """All pairs between different components of members of larger buckets whose prefixes allow a link."""
    rows = _prefixes(open_, sets, p)
    # the smaller set of a linked pair has to share 2 * percent / (100 + percent) of its shingles
    role = lambda r: [F.col(c).alias(f"{k}{r}") for c, k in (
        ("n", "n"), ("pos", "p"), ("component", "c"), ("main", "main_"), ("firsts", "f"), ("reach", "e"))]
    small = rows.where((F.col("n") - F.col("pos")) * (100 + p.percent) >= F.col("n") * 2 * p.percent).select(
        "shingle", F.col("rep").alias("x"), *role("x"))
    large = rows.select("shingle", F.col("rep").alias("y"), *role("y"))
    more = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))  # the most they can share from here on
    # Common shingles up to the earlier end of both firsts are in both; the others stand beyond that end in its set.
    both = F.array_intersect("fx", "fy")  # in their order
    most = F.size(both) + F.greatest(F.col("nx") - F.col("ex"), F.col("ny") - F.col("ey"))
    enough = lambda shared: shared * (100 + p.percent) >= (F.col("nx") + F.col("ny")) * p.percent
    fits = ((F.col("cx") != F.col("cy")) & ((F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y"))))
            & enough(more) & enough(most)
            # A linked pair meets at its first common shingle; other rows of it are not needed.
            & ((F.size(both) == 0) | (F.get(both, F.lit(0)) == F.col("shingle"))))
    # two rows of the main component make no pair, so its rows meet only those of others
    pairs = small.where("not main_x").join(large, "shingle").where(fits).select("x", "y").unionByName(
        small.where("main_x").join(large.where("not main_y"), "shingle").where(fits).select("x", "y"))
    return _ordered(pairs).distinct()


def _sets_of(docs: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """(rep, set) of the ``wanted`` (rep, c1, c2, rank_id): named ones are picked by id, the others by their digest."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    picked = rows.join(wanted.select(F.col("rank_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = shingle_sets(picked.unionByName(rows.where("doc_id is null")), p)
    return sets.dropDuplicates(["c1", "c2"]).join(wanted, ["c1", "c2"]).select("rep", "set")


def _decided(docs: DataFrame, p: Params) -> DataFrame:
    """``near_duplicates`` with the ``text_key`` of each row."""
    signed = stored(signatures(docs, p), "signatures").withColumn("rank_id", F.coalesce("doc_id", F.lit(LAST_ID)))
    # rows of one digest have one size and one list of keys
    reps = stored(
        signed.where("n_shingles > 0").groupBy("c1", "c2").agg(
            F.min("rank_id").alias("rank_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"))
        .withColumn("rep", F.monotonically_increasing_id()), "representatives")
    members = buckets(reps.select("rep", "n_shingles", "keys"))
    wanted = reps.select("rep", "c1", "c2", "rank_id").join(members.select("rep").distinct(), "rep")
    sets = stored(_sets_of(docs, wanted, p), "sets")

    tested = stored(_verified(_star_pairs(members, p), sets, p), "tested")
    labels = connected_components(tested.where("linked"))
    open_ = _open_buckets(members, labels)
    further = _pairs_in_small(open_, p).unionByName(_pairs_in_large(open_, sets, p)).distinct()
    found = stored(_verified(further.join(tested, ["a", "b"], "left_anti"), sets, p), "tested")
    if not found.where("linked").isEmpty():
        labels = connected_components(tested.unionByName(found).where("linked"))
    ranks = labels.withColumnRenamed("node", "rep").join(reps.select("rep", "rank_id"), "rep")
    lowest = ranks.groupBy("component").agg(F.min("rank_id").alias("low"))
    linked = ranks.join(lowest, "component").select("rep", "low")
    names = reps.select("c1", "c2", "rep", "rank_id").join(linked, "rep", "left").select(
        "c1", "c2", F.coalesce("low", "rank_id").alias("component"))
    out = signed.join(names, ["c1", "c2"], "left").select(  # rows without words have no representative
        "doc_id", "text_key", "n_shingles", F.coalesce("component", "rank_id").alias("component"), "rank_id")
    return out.select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("component") == LAST_ID, F.lit(None)).otherwise(F.col("component")).cast("long").alias("component_id"),
        (F.col("component") == F.col("rank_id")).alias("kept"))


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; kept: it is its component's smallest id."""
    return _decided(docs, p).drop("text_key")


def drop_near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component, with their columns.

    Rows without words have no near duplicate and stay; of rows with a null id that share a component all stay.
    """
    gone = _decided(docs, p).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_gone_id")) & (_text_key() == F.col("_gone_key"))
    return docs.join(gone, same, "left_anti")

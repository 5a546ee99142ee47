"""Line dedup over the whole corpus, returning keep bitmaps instead of text.

A line's key is the line without surrounding ASCII white space, with A-Z in lower
case.  A key of at least ``min_chars`` code points found in several documents
keeps its lines only in the smallest ``doc_id`` that holds it.

1. Each line with a long enough key becomes (128-bit key hash, document,
   position); the text stays behind.
2. These rows are *range*-partitioned by (hash, document, position) and sorted
   within partitions.  As the range includes document and position, a line found
   in a third of all documents spreads over many partitions.
3. Each partition is streamed in order: the first document of a hash keeps its
   lines, later ones lose theirs.  Only the first hash of a partition can have
   begun in an earlier partition; its undecided lines, and the last hash of every
   partition, are settled in a second, small step (rows of one document per
   partition).
4. Lost positions are gathered per document into a zlib-compressed bitmap:
   bit 1 keeps the line, 0 drops it, and lines past its end stay.

Defined cases: null and empty texts are one empty line; repeated lines inside the
document that keeps them all stay; rows with a null ``doc_id`` rank last and
are told apart by their text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import LAST_ID, id_and_text, pieces_of, stored

_ROW = "h1 long, h2 long, rank_id long, text_key long, pos int"
_JUDGED = f"{_ROW}, kind int"
_DROP, _OPEN, _LAST = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """bytes.strip() and bytes.lower() know exactly ASCII white space and A-Z."""
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _ranked(docs: DataFrame) -> DataFrame:
    """(doc_id, rank_id, text_key, text): rank_id and text_key name a document also where its id is null."""
    null = F.col("doc_id").isNull()
    return id_and_text(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("rank_id"),
        F.when(null, F.xxhash64("text")).otherwise(F.lit(0)).alias("text_key"), "text")


def line_rows(ranked: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, rank_id, text_key, pos) of every line whose key is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            digests, counts, places = [], [], []
            for text in batch.column("text").to_pylist():
                n = 0
                for pos, line in enumerate(text.encode().split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
                        places.append(pos)
                        n += 1
                counts.append(n)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            owner = {c: np.repeat(batch.column(c).to_numpy(), counts) for c in ("rank_id", "text_key")}
            yield pa.record_batch({
                "h1": pa.array(halves[:, 0].copy()), "h2": pa.array(halves[:, 1].copy()),
                "rank_id": pa.array(owner["rank_id"], pa.int64()), "text_key": pa.array(owner["text_key"], pa.int64()),
                "pos": pa.array(np.array(places, dtype=np.int32)),
            })

    return ranked.select("rank_id", "text_key", "text").mapInArrow(run, _ROW)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted range: lines to drop, undecided lines of the first hash, and the last hash.

    Keeps only the current hash and its first document between batches.
    """
    opening = current = owner = None  # (h1, h2) of the range, of the last row; (rank_id, text_key)
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, rank, key, pos = (batch.column(i).to_numpy() for i in range(5))
        new_hash = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        first = np.flatnonzero(new_hash)
        group = np.cumsum(new_hash) - 1
        own_rank, own_key = rank[first].copy(), key[first].copy()
        if opening is None:
            opening = (h1[0], h2[0])
        if current == (h1[0], h2[0]):  # the hash goes on from the batch before
            own_rank[0], own_key[0] = owner
        later = (rank != own_rank[group]) | (key != own_key[group])
        undecided = ~later & (h1 == opening[0]) & (h2 == opening[1])
        kind = np.where(later, _DROP, _OPEN).astype(np.int32)
        out = later | undecided
        if out.any():
            yield pa.record_batch([pa.array(x[out]) for x in (h1, h2, rank, key, pos, kind)],
                                  names=["h1", "h2", "rank_id", "text_key", "pos", "kind"])
        current, owner = (h1[-1], h2[-1]), (own_rank[-1], own_key[-1])
    if current is not None:
        yield pa.record_batch({
            "h1": [current[0]], "h2": [current[1]], "rank_id": [owner[0]], "text_key": [owner[1]],
            "pos": pa.array([-1], pa.int32()), "kind": pa.array([_LAST], pa.int32())})


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for lost in batch.column("lost"):
            at = lost.values.to_numpy()
            bits = np.ones(int(at.max()) + 1, dtype=np.uint8)
            bits[at] = 0
            maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        ends = [int(x.values.to_numpy().max()) + 1 for x in batch.column("lost")]
        yield pa.record_batch({
            "rank_id": batch.column("rank_id"), "text_key": batch.column("text_key"),
            "bits": pa.array(ends, pa.int32()), "keep_bitmap": pa.array(maps, pa.binary())})


def keep_bitmaps(ranked: DataFrame, min_chars: int = 10) -> DataFrame:
    """(rank_id, text_key, bits, keep_bitmap) of every document that loses a line."""
    order = ["h1", "h2", "rank_id", "text_key", "pos"]
    judged = stored(
        line_rows(ranked, min_chars).repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_judge, _JUDGED), "judged-lines")
    # First document of a hash over all ranges that it touches, where a range ends or begins with it.
    edges = judged.where(F.col("kind") != _DROP)
    owners = edges.groupBy("h1", "h2").agg(F.min(F.struct("rank_id", "text_key")).alias("owner"))
    place = ["rank_id", "text_key", "pos"]
    settled = (
        edges.where(F.col("kind") == _OPEN).join(owners, ["h1", "h2"])
        .where(F.struct("rank_id", "text_key") != F.col("owner")).select(*place)
    )
    lost = judged.where(F.col("kind") == _DROP).select(*place).unionByName(settled)
    return (
        lost.groupBy("rank_id", "text_key").agg(F.collect_list("pos").alias("lost"))
        .mapInArrow(_bitmaps, "rank_id long, text_key long, bits int, keep_bitmap binary")
    )


def kept_lines(text: str, bits: int | None, keep_bitmap: bytes | None) -> tuple[list[bytes], int]:
    """The lines that stay and the number of lines before, for one text and its bitmap."""
    lines = text.encode().split(b"\n")
    if keep_bitmap is None:
        return lines, len(lines)
    keep = np.unpackbits(np.frombuffer(zlib.decompress(keep_bitmap), dtype=np.uint8), count=bits, bitorder="little")
    return [x for x, k in zip(lines, keep.tolist()) if k] + lines[bits:], len(lines)


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, keep_bitmap) of every document."""
    ranked = _ranked(docs)
    maps = stored(keep_bitmaps(ranked, min_chars), "line-bitmaps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            n, dropped, sha = [], [], []
            for text, bits, bitmap in zip(*(batch.column(c).to_pylist() for c in ("text", "bits", "keep_bitmap"))):
                lines, before = kept_lines(text, bits, bitmap)
                n.append(before)
                dropped.append(before - len(lines))
                sha.append(hashlib.sha256(b"\n".join(lines)).hexdigest())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_lines": pa.array(n, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
                "keep_bitmap": batch.column("keep_bitmap")})

    # Bitmaps are small against texts; the hash join needs no sort of the texts.
    joined = ranked.join(maps.hint("shuffle_hash"), ["rank_id", "text_key"], "left")
    return joined.select("doc_id", "text", "bits", "keep_bitmap").mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, keep_bitmap binary")

"""Alignment of two tokenizers by divide and conquer at shared cuts.

A byte offset where a token of A and a token of B both end is a shared cut.  An
interval of a text is divided at the shared cut nearest to its middle, found by
bisecting, and both halves are treated alike; an interval without a cut is a
leaf, one group of tokens.  The intervals of all new parts of an Arrow slice are
divided together, level by level.

The first cuts of a text are known beforehand: before a single space, and around a
single newline, between characters that are no white space, both tokenizers end
a token, and the parts between them are encoded independently (tests hold that
against whole texts).  So each part, mostly a word, is encoded, divided and linked
once, and remembered in a table per Python worker that is bounded by bytes (when it is
full, parts that came up rarely go); texts with other white space are cut at fewer
places, or not at all.

Links are all pairs of an A token and a B token whose byte ranges overlap.  How many
documents hold an id pair linked, and how its count ranks among those of its A id,
are corpus statistics:

1. Each document's distinct pairs, with how often they occur in it, are stored.
2. Documents per pair are counted by one aggregation (map-side first), and compared
   with the highest count of the A id (at most one row per B id).
3. The ``HEAVY`` most frequent pairs, a fixed number, are broadcast, and a
   document's sums over them are taken where it lies.  All other pairs are joined
   by key; none of them holds more than the ``HEAVY``-th part of all rows, so no
   task meets a hot key however frequent some words are.

Defined cases: texts that are null, empty, or whose tokens do not spell a space and
the text have no tokens: zeros and ''; special-token strings are plain text; every row
counts as a document, a repeated one too; texts may be of any length; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import forget, id_and_text, stored

#: The marks of B's vocabulary: a space, and a single byte.
SPACE, _BYTE = "▁", re.compile("<0x([0-9A-F]{2})>")
#: Pairs whose counts every task gets.
HEAVY = 65_536
#: Bytes that a worker's table of parts may take; texts of one slice.
REMEMBERED, SLICE_BYTES, SLICE_ROWS = 120_000_000, 4_000_000, 512
#: White space of any tokenizer's definition, and characters that some count as such.
_ODD = r"\s\x1c-\x1f\x85\u180e\u200b-\u200d\u2060\ufeff\u2581"
#: A text is cut at every space and newline unless it has one beside such a character or an end.
_UNEVEN = re.compile(f"^[{_ODD}]|[ \n](?:[{_ODD}]|\\Z)|[{_ODD}][ \n]|{SPACE}")
_SAFE_SPACE = re.compile(f"(?<=[^ {SPACE}]) (?=[^{_ODD}])")


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the others follow at 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def divide(ends_a: np.ndarray, ends_b: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The groups of token intervals, in order: rows (first of A, end of A, first of B, end of B).

    ``whole`` has such rows for intervals that end at the same byte.  All intervals of a level are divided together:
    each at the common end nearest to its middle, found by bisecting; those without one are leaves.
    """
    at_b = np.searchsorted(ends_b, ends_a)
    shared = np.flatnonzero(ends_b[np.minimum(at_b, len(ends_b) - 1)] == ends_a)
    leaves, level = [], whole
    while len(level):
        a0, a1, b0, b1 = level.T
        middle = (a0 + a1 - 1) // 2
        k = np.searchsorted(shared, middle)
        right, left = shared[np.minimum(k, len(shared) - 1)], shared[np.maximum(k - 1, 0)]
        on_right = (right >= middle) & (right < a1 - 1)
        on_left = (left >= a0) & (left < np.minimum(middle, a1 - 1))
        cut = np.where(on_left & (~on_right | (middle - left <= right - middle)), left, right)
        has = on_left | on_right
        leaves.append(level[~has])
        a0, a1, b0, b1, i = a0[has], a1[has], b0[has], b1[has], cut[has]
        j = at_b[i]
        level = np.concatenate([np.stack([a0, i + 1, b0, j + 1], 1), np.stack([i + 1, a1, j + 1, b1], 1)])
    groups = np.concatenate([np.zeros((0, 4), dtype=np.int64), *leaves])
    return groups[np.argsort(groups[:, 0])]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all overlapping tokens: two overlap in one stretch, which ends where the first of them does."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class Aligner:
    """Encodes texts with both vocabularies and aligns their tokens, part by part."""

    def __init__(self, a_path: str, b_path: str):
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_level_alphabet()
        self.bytes_a = [self._level(alphabet, self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # An id as text, with the mark after it: inside its side of a group, and at the side's end.
        self.names_a, self.names_b = (
            np.array([[f"{i}," for i in range(n)], [f"{i}{end}" for i in range(n)]], dtype=object)
            for n, end in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")))
        pieces = [self.b.id_to_piece(i) for i in range(len(self.bytes_b))]
        #: B's parts are independent if no piece has a newline, or a space after another character.
        self.cuttable = not any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces)
        self._forget()

    @staticmethod
    def _level(alphabet: dict[str, int], token: str) -> bytes:
        try:
            return bytes(alphabet[c] for c in token)
        except KeyError:  # an added token, which plain text never gives
            return token.encode()

    def _forget(self) -> None:
        """Start the table anew: per part its counts, its groups as text, and its links in one pool."""
        self.place: dict[str, int] = {}
        self.text: list[str] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A and of B, groups, links
        self.first = np.zeros(0, dtype=np.int64)
        self.seen = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.int64)
        self.bytes = 0

    def _thin_out(self) -> None:
        """Keep the parts that were met several times since the last call, if they are less than half of the table."""
        keep = np.flatnonzero(self.seen >= 3)
        if 2 * len(keep) > len(self.text):
            return self._forget()
        names = list(self.place)  # in the order of their places
        place = {names[k]: n for n, k in enumerate(keep.tolist())}
        text, counts = [self.text[k] for k in keep.tolist()], self.counts[keep]
        starts = np.cumsum(counts[:, 3]) - counts[:, 3]
        pool = self.pool[np.arange(int(counts[:, 3].sum())) + np.repeat(self.first[keep] - starts, counts[:, 3])]
        self.place, self.text, self.counts, self.first, self.pool = place, text, counts, starts, pool
        self.seen = np.zeros(len(keep), dtype=np.int64)
        self.bytes = self._size(place, text, len(pool))

    @staticmethod
    def _size(parts: Iterable[str], text: list[str], links: int) -> int:
        return sum(map(len, text)) + sum(300 + 2 * len(p) for p in parts) + 8 * links

    # -- encoding -------------------------------------------------------------------
    def encode_b(self, part: str) -> list[int]:
        """B's ids of a part that begins with a space or newline; the library adds a space of its own."""
        return self.b.encode(part[1:]) if part[0] == " " else self.b.encode(part)[1:]

    def parts(self, text: str) -> list[str] | None:
        """Parts of a space and ``text`` that are cut at every space and newline, or None if it has other white space."""
        if not self.cuttable or _UNEVEN.search(text):
            return None
        return [w if w[0] == "\n" else " " + w for w in text.replace("\n", " \n").split(" ")]

    def uneven_parts(self, text: str) -> list[str]:
        text = " " + text
        if not self.cuttable:
            return [text]
        cuts = [0, *(m.start() for m in _SAFE_SPACE.finditer(text, 1)), len(text)]
        return [text[x:y] for x, y in zip(cuts, cuts[1:])]

    def learn(self, parts: list[str]) -> bool:
        """Align parts that may follow each other, encoded in one call; False if their tokens don't spell them."""
        whole = "".join(parts)
        ids_a = self.a.encode(whole, add_special_tokens=False).ids
        ids_b = self.encode_b(whole)
        raw = whole.encode()
        if b"".join([self.bytes_a[i] for i in ids_a]) != raw or b"".join([self.bytes_b[i] for i in ids_b]) != raw:
            return False
        ids_a, ids_b = np.array(ids_a), np.array(ids_b)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        ends = np.cumsum([len(p.encode()) for p in parts])
        stop_a, stop_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        if not (np.array_equal(ends_a[stop_a], ends) and np.array_equal(ends_b[stop_b], ends)):
            return False
        stop_a, stop_b = stop_a + 1, stop_b + 1
        start_a, start_b = np.concatenate([[0], stop_a[:-1]]), np.concatenate([[0], stop_b[:-1]])
        groups = divide(ends_a, ends_b, np.stack([start_a, stop_a, start_b, stop_b], 1))
        # A's ids of a group stand before B's.
        sizes_a, sizes_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
        last_a, last_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        last_a[groups[:, 1] - 1] = last_b[groups[:, 3] - 1] = 1
        said = np.empty(len(ids_a) + len(ids_b), dtype=object)
        said[np.arange(len(ids_a)) + np.repeat(groups[:, 2], sizes_a)] = self.names_a[last_a, ids_a]
        said[np.arange(len(ids_b)) + np.repeat(groups[:, 1], sizes_b)] = self.names_b[last_b, ids_b]
        said = said.tolist()
        i, j = overlaps(ends_a, ends_b)
        links = ids_a[i] * len(self.bytes_b) + ids_b[j]
        stop_links = np.searchsorted(i, stop_a)
        n_links = np.diff(stop_links, prepend=0)
        n_groups = np.diff(np.searchsorted(groups[:, 0], stop_a), prepend=0)
        at = 0
        text = []
        for to in (stop_a + stop_b).tolist():
            text.append("".join(said[at:to])[:-1])
            at = to
        self.place.update(zip(parts, range(len(self.text), len(self.text) + len(parts))))
        self.text += text
        self.first = np.concatenate([self.first, len(self.pool) + stop_links - n_links])
        self.counts = np.concatenate([self.counts, np.stack([stop_a - start_a, stop_b - start_b, n_groups, n_links], 1)])
        self.seen = np.concatenate([self.seen, np.zeros(len(parts), dtype=np.int64)])
        self.pool = np.concatenate([self.pool, links])
        self.bytes += self._size(parts, text, len(links))
        return True

    def align_alone(self, part: str) -> int | None:
        """Place of one part, encoded by itself, or None if its tokens don't spell it."""
        if part in self.place or self.learn([part]):
            return self.place[part]
        return None

    # -- documents --------------------------------------------------------------------
    def places(self, texts: list[str]) -> list[list[int]]:
        """Per text the places of its parts; none for a text without tokens."""
        if self.bytes > REMEMBERED:
            self._thin_out()
        cut = [self.parts(t) if t else [] for t in texts]
        fresh = list(dict.fromkeys(p for parts in cut if parts for p in parts if p not in self.place))
        if fresh and not self.learn(fresh):  # some part isn't spelled by its tokens
            cut = [None if t else [] for t in texts]
        out = []
        for text, parts in zip(texts, cut):
            if parts is None:
                alone = [self.align_alone(p) for p in self.uneven_parts(text)]
                if None in alone:  # the whole text decides
                    alone = [self.align_alone(" " + text)]
                out.append([] if None in alone else alone)
            else:
                out.append(list(map(self.place.__getitem__, parts)))
        return out

    def documents(self, texts: list[str]) -> dict[str, pa.Array]:
        """Per text its counts, the hash of its groups, and its distinct links with their numbers."""
        places = self.places(texts)
        shas = [hashlib.sha256(";".join(map(self.text.__getitem__, p)).encode()).hexdigest() if p else "" for p in places]
        sizes = np.array([len(p) for p in places], dtype=np.int64)
        at = np.fromiter((k for p in places for k in p), dtype=np.int64, count=int(sizes.sum()))
        doc = np.repeat(np.arange(len(texts)), sizes)
        counts = np.zeros((len(texts), 4), dtype=np.int64)
        for c in range(4):
            counts[:, c] = np.bincount(doc, weights=self.counts[at, c], minlength=len(texts))  # exact below 2^53
        self.seen += np.bincount(at, minlength=len(self.text))
        # Parts of a document once, with their numbers; then their links.
        seen, times = np.unique(doc * max(1, len(self.text)) + at, return_counts=True)
        doc, at = np.divmod(seen, max(1, len(self.text)))
        links = self.counts[at, 3]
        starts = np.cumsum(links) - links
        from_pool = np.arange(int(links.sum())) + np.repeat(self.first[at] - starts, links)
        span = len(self.bytes_a) * len(self.bytes_b)
        keys = np.repeat(doc, links) * span + self.pool[from_pool]
        times = np.repeat(times, links)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(times, new) if len(new) else times
        doc, pairs = np.divmod(keys[new], span)
        offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
        as_lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(offsets), pa.array(x, kind))
        return {
            **{name: pa.array(counts[:, c].copy()) for c, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "groups_sha256": pa.array(shas, pa.string()),
            "pairs": as_lists(pairs, pa.int64()), "times": as_lists(times, pa.int64()),
        }


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker."""
    return Aligner(a_path, b_path)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches bounded by rows and by bytes of text (a longer text is a slice of its own)."""
    for batch in batches:
        ends = np.cumsum([len(t.encode()) for t in batch.column("text").to_pylist()])
        at = 0
        while at < batch.num_rows:
            limit = (ends[at - 1] if at else 0) + SLICE_BYTES
            to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, limit, side="right"))))
            yield batch.slice(at, to - at)
            at = to


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every document.

    ``pairs`` are its distinct links, as A id times the size of B's vocabulary plus B id, and ``times`` their numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in slices(batches):
            found = both.documents(batch.column("text").to_pylist())
            yield pa.record_batch({"row": batch.column("row"), "doc_id": batch.column("doc_id"), **found})

    rows = id_and_text(docs).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(run, f"row long, doc_id long, {_COUNTS}, pairs array<long>, times array<long>")


def with_best(counts: DataFrame, n_b: int) -> DataFrame:
    """``counts (pair, docs)`` and whether no pair of the same A id has more documents."""
    a = F.expr(f"pair div {n_b}")
    highest = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))  # at most one row per A id
    return counts.join(highest, a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark = docs.sparkSession
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    rows = stored(aligned(docs, a_path, b_path), "alignment-rows")
    counted = stored(
        rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")),
        "alignment-counts")
    counts = stored(with_best(counted, n_b), "alignment-ranked")
    forget(counted)
    top = counts.orderBy(F.desc("docs"), "pair").limit(heavy).toArrow().sort_by("pair")  # a fixed number of rows
    shared = spark.sparkContext.broadcast(tuple(
        np.array(top.column(c).to_numpy()) for c in ("pair", "docs", "best")))

    def sum_heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs_of, best = shared.value
        for batch in batches:
            pairs, times = (batch.column(c) for c in ("pairs", "times"))
            sizes = np.diff(pairs.offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(sizes)])
            pair, n = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.searchsorted(known, pair)
            hit = np.zeros(len(pair), dtype=bool)
            hit[at < len(known)] = known[at[at < len(known)]] == pair[at < len(known)]
            at[~hit] = 0

            def per_document(values: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(values)])[ends])

            offsets = pa.array(np.concatenate([[0], np.cumsum(per_document(~hit))]).astype(np.int32))
            n_hit = np.where(hit, n, 0)
            yield pa.record_batch({
                **{c: batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")},
                "n_best": pa.array(per_document(n_hit * best[at]) if len(known) else np.zeros(len(sizes), dtype=np.int64)),
                "count_sum": pa.array(per_document(n_hit * docs_of[at]) if len(known) else np.zeros(len(sizes), dtype=np.int64)),
                "pairs": pa.ListArray.from_arrays(offsets, pa.array(pair[~hit])),
                "times": pa.ListArray.from_arrays(offsets, pa.array(n[~hit]))})

    summed = stored(rows.mapInArrow(
        sum_heavy, f"row long, doc_id long, {_COUNTS}, n_best long, count_sum long, pairs array<long>, times array<long>"),
        "alignment-summed")
    forget(rows)
    light = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    rest = (
        light.join(counts, F.col("pairs") == F.col("pair"))
        .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                            F.sum(F.col("times") * F.col("docs")).alias("more_sum"))
    )
    zero = F.lit(0).cast("long")
    return summed.drop("pairs", "times").join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"), "groups_sha256")

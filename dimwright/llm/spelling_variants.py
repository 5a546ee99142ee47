"""Spelling variants by dense prefix-suffix tiling.

1. Words are counted per task in a bounded table, then by one aggregation.
2. Two words that differ by one edit share their first or their last half: with
   the longer one of ``size`` code points, a common prefix and a common suffix
   that together reach ``size - 1`` cannot both be shorter than ``size // 2``.  So each word
   joins four groups: by the half at either end, once as a word of the group's
   size and once as one that is a code point shorter.
3. Groups are cut into tiles, pairs of blocks of at most ``TILE`` words (fewer if
   they are long).  A tile writes its words into a matrix of code points, padded
   to one width and aligned left, and into a second one aligned right; comparing
   them column by column, all pairs at once, gives every pair's common prefix
   and common suffix.  They are a single edit apart if both together reach the
   longer length minus one.  A pair whose prefix reaches the half belongs to
   the prefix group, any other to the suffix group, so each is counted once.
4. A tile returns one row per word: how many near words, and the best of them.
5. Roots: forms are followed by pointer jumping.  A form occurs at least twice as
   often as its word, so a path is no longer than log2 of the largest count and
   the number of rounds grows with the logarithm of that.

Only words, never texts, are shuffled.  Affixes go by their hashes; words that meet
by a collision are compared like any others, so nothing depends on it.

Defined cases: null and empty texts have no words; a null ``doc_id`` counts as the
empty text in the deletion rule; a repeated row counts its words again; a run or word
may be of any length; ties of the largest count go to the smallest word in
code-point order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import forget, id_and_text, pieces_of, stored

#: Runs of letters: A-Z, a-z and U+00C0 to U+00FF.
RUN = re.compile(r"[A-Za-z\u00C0-\u00FF]+")
MIN_LENGTH, MIN_COUNT = 5, 3
#: One run of ``DROP`` loses a code point, chosen by its checksum.
DROP = 97
#: Words of a tile's block, and code points of it.
TILE, TILE_POINTS = 128, 1 << 18
#: Words and code points that a task counts before it passes the counts on.
COUNTED, COUNTED_POINTS = 200_000, 16_000_000
#: Texts are searched in stretches of about this many characters, cut between runs.
STRETCH = 1 << 20
_NOT_RUN = re.compile(r"[^A-Za-z\u00C0-\u00FF]")


def spelled(doc_id: str, run: str) -> str:
    """The word that a lower-cased run of a document stands for."""
    return _spelled(zlib.crc32(f"{doc_id}:".encode()), run)


def _spelled(start: int, run: str) -> str:
    h = zlib.crc32(run.encode(), start)
    if h % DROP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _stretches(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = min(len(text), at + STRETCH)
        if end < len(text) and (stop := _NOT_RUN.search(text, end)):
            end = stop.start()
        elif end < len(text):
            end = len(text)
        yield text[at:end]
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task's documents, in a few parts if there are very many words."""
    words: Counter = Counter()
    points = 0
    for batch in pieces_of(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for part in _stretches(text):
                # Lower-casing the bytes changes A-Z only.
                for run, n in Counter(RUN.findall(part.encode().lower().decode())).items():
                    word = _spelled(start, run)
                    if len(word) >= MIN_LENGTH:
                        before = len(words)
                        words[word] += n
                        points += len(word) * (len(words) - before)
            if len(words) >= COUNTED or points >= COUNTED_POINTS:
                yield _counted(words)
                words, points = Counter(), 0
    if words:
        yield _counted(words)


def _counted(words: Counter) -> pa.RecordBatch:
    return pa.record_batch({"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})


def count_words(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words found at least ``min_count`` times in all documents."""
    return (id_and_text(docs).mapInArrow(_count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ----------------------------------------------------------------------------
# tiles
# ----------------------------------------------------------------------------


def _common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common start of every row of ``left`` with every row of ``right``."""
    alive = np.ones((len(left), len(right)), dtype=bool)
    length = np.zeros(alive.shape, dtype=np.int32)
    for a, b in zip(left.T, right.T):
        alive &= a[:, None] == b[None, :]
        if not alive.any():
            break
        length += alive
    return length


def _points(words: list[str], size: int) -> np.ndarray:
    """A row of code points per word; words fill their row."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), size)


def near_pairs(rows: list[str], full: list[str], shorter: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``rows`` are a single edit from which of ``full`` and then ``shorter``, and their common prefixes.

    Words of ``rows`` and ``full`` have ``size`` code points, those of ``shorter`` one less; their padding equals nothing.
    """
    of_rows = _points(rows, size)
    prefix = _common(of_rows, _points([*full, *(w + "\0" for w in shorter)], size))
    suffix = _common(of_rows[:, ::-1], _points([*full, *("\0" + w for w in shorter)], size)[:, ::-1])
    return (prefix + suffix >= size - 1) & (prefix < size), prefix


def _tile(size: int, by_prefix: bool, same: bool, members: list[dict]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, the best one's count, the best one) of one tile's pairs."""
    half = size // 2
    best: dict[str, tuple[int, int, str]] = {}

    def see(word: str, other: str, n: int) -> None:
        seen = best.get(word)
        if seen is None:
            best[word] = (1, n, other)
        else:
            better = (-n, other) < (-seen[1], seen[2])
            best[word] = (seen[0] + 1, n if better else seen[1], other if better else seen[2])

    def compare(rows: list[dict], full: list[dict], shorter: list[dict], within: bool = False) -> None:
        if not rows or not (full or shorter):
            return
        near, prefix = near_pairs(*([m["word"] for m in x] for x in (rows, full, shorter)), size)
        near &= (prefix >= half) if by_prefix else (prefix < half)
        if within:  # ``rows`` and ``full`` are the same words: each pair once
            near[:, : len(full)] &= np.triu(np.ones((len(rows), len(full)), dtype=bool), 1)
        others = full + shorter
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            p, q = rows[i], others[j]
            see(p["word"], q["word"], q["n"])
            see(q["word"], p["word"], p["n"])

    first = min(m["block"] for m in members)
    blocks: tuple[list, list, list, list] = ([], [], [], [])
    for m in members:
        blocks[2 * (m["block"] != first) + (len(m["word"]) < size)].append(m)
    full, shorter, full_two, shorter_two = blocks
    if same:
        compare(full, full, shorter, within=True)
    else:
        compare(full, full_two, shorter_two)
        compare(full_two, [], shorter)
    for word, (near, n, other) in best.items():
        yield word, near, n, other


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 64):
        found = []
        for row in batch.to_pylist():
            found += _tile(row["size"], row["by_prefix"], row["i"] == row["j"], row["members"])
        word, near, n, other = zip(*found) if found else ((), (), (), ())
        yield pa.record_batch({
            "word": pa.array(word, pa.string()), "near": pa.array(near, pa.int64()),
            "best_n": pa.array(n, pa.int64()), "best": pa.array(other, pa.string())})


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best, best_n) of the words of ``words (word, n)`` that have one a single edit away."""
    size = F.length("word")
    places = F.explode(F.array(*[
        F.struct((size + more).alias("size"), F.lit(by_prefix).alias("by_prefix"),
                 F.xxhash64(F.expr(f"{'left' if by_prefix else 'right'}(word, (length(word) + {more}) div 2)")).alias("key"))
        for more in (0, 1) for by_prefix in (True, False)]))
    member = words.select("word", "n", places.alias("at")).select("word", "n", "at.*")
    group = ["size", "by_prefix", "key"]
    room = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_POINTS) / F.col("size")))).cast("long")
    # Groups of more than a tile: fewer than words / tile of them.
    crowded = stored(
        member.groupBy(*group).agg(F.count(F.lit(1)).alias("words"))
        .select(*group, F.ceil(F.col("words") / room).alias("blocks")).where("blocks > 1"), "spelling-crowded", small=True)
    dealt = member.join(crowded, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("word", F.lit("block")), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiles = (
        dealt.groupBy(*group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .agg(F.collect_list(F.struct("word", "n", "block")).alias("members"))  # at most two blocks
        .where((F.size("members") > 1) & F.exists("members", lambda m: F.length(m["word"]) == F.col("size")))
    )
    near = tiles.select("size", "by_prefix", "i", "j", "members").mapInArrow(
        _compare, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    out = near.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))
    out = stored(out, "spelling-near")
    forget(crowded)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms (word, form)``, none of them null: the end of each word's path."""
    paths = stored(forms.select("word", F.col("form").alias("root")), "spelling-paths")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(
            paths.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-paths")
        forget(paths)
        paths = after
        if after.where("moved").isEmpty():
            return after.select("word", "root")


def spelling_variants(docs: DataFrame, min_count: int = MIN_COUNT, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``; see the module's text."""
    words = stored(count_words(docs, min_count), "spelling-words")
    best = near_words(words, tile)
    formed = F.col("best_n") >= 2 * F.col("n")
    judged = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")),
        "spelling-forms")
    ends = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

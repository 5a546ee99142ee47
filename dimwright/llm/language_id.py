"""Language identification by words first, character n-grams as the way back.

Model: per language the log frequency of known words, and of character n-grams of
five to one characters (of words with a mark at both ends).  A word that the
model knows is scored by its word frequencies; any other word by its longest
n-grams that are known: five characters, then four, and so on.  A text's score is
the sum over its words; the prediction is the best language, and its posterior
probability is the score.

The model is fitted on a bounded sample and has a bounded size, both parameters:
about ``docs_per_language`` labelled documents of each language, chosen by a
hash of the id; of ``max_words`` words and ``max_grams`` n-grams of each order every
language names an equal share, its own most frequent ones (words that it has at least
twice).  So a language with few documents keeps its words beside one with many, and
every language of the labels can be predicted.  It is counted on the executors; only
the bounded tables reach the driver and go back to every Python worker as one
broadcast.  Prediction reads every whole text.

Words are runs of letters, with the marks that combine with them, in lower case;
labels, sources and ids are never inputs of a prediction.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is no labelled document to learn from; ties go to the
language that sorts first; repeated rows get equal results; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import pieces_of, ship_package, stored

UNKNOWN = "und"
#: Folds by crc32(doc_id as text) mod 4; this one is held out.
FOLDS, HELD_OUT = 4, 2
ORDERS = (5, 4, 3, 2, 1)
#: Unknown words remembered per Python worker.
REMEMBERED = 200_000


def _marks() -> str:
    """Ranges of the characters that combine with letters (Unicode classes Mn and Mc), for a pattern."""
    codes = [c for c in range(0x300, sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    starts = [c for c, before in zip(codes, [-1, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -1]) if c != after - 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


_WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")


@dataclass(frozen=True)
class Params:
    docs_per_language: int = 4_000
    max_words: int = 50_000
    max_grams: int = 20_000
    smoothing: float = 0.5


@dataclass(frozen=True)
class Model:
    """Languages, and per known word or n-gram a row of log frequencies per language."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    rows: np.ndarray


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    marked = f"<{word}>" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the fold of a document is the held-out one; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 0) and n-grams (kind = order) per language, summed over a task's part of the sample."""
    found: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            found.setdefault(lang, Counter()).update(words_of(text))
    for lang, words in found.items():
        grams = Counter()
        for word, n in words.items():
            for order in ORDERS:
                for g in grams_of(word, order):
                    grams[order, g] += n
        rows = [(0, w, n) for w, n in words.items()] + [(o, g, n) for (o, g), n in grams.items()]
        for at in range(0, len(rows), 50_000):
            kind, key, n = zip(*rows[at : at + 50_000])
            yield pa.record_batch({
                "lang": pa.array([lang] * len(kind), pa.string()), "kind": pa.array(kind, pa.int32()),
                "key": pa.array(key, pa.string()), "n": pa.array(n, pa.int64())})


def fit(docs: DataFrame, p: Params = Params()) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    ship_package(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").cast("string").alias("lang"), "text")
    sizes = labelled.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return Model([], {}, {}, np.zeros((0, 0)))
    # A share per language, so the sample stays near docs_per_language however large the table is.
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, p.docs_per_language / r["count"]))])
    chance = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / (1 << 30)
    sample = labelled.where(chance < share[F.col("lang")]).select("lang", "text")
    counts = stored(
        sample.mapInArrow(_counts, "lang string, kind int, key string, n long")
        .groupBy("kind", "key", "lang").agg(F.sum("n").alias("n")), "language-counts")
    totals = counts.groupBy("kind", "lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).collect()
    own = Window.partitionBy("kind", "lang").orderBy(F.desc("n"), "key")
    share = F.when(F.col("kind") == 0, max(1, p.max_words // len(sizes))).otherwise(max(1, p.max_grams // len(sizes)))
    named = counts.where("kind > 0 or n > 1").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= share)
    chosen = named.select("kind", "key").distinct()
    kept = counts.join(chosen, ["kind", "key"], "left_semi").toArrow()  # bounded by the limits
    return _model(sorted(r["lang"] for r in sizes), totals, kept, p)


def _model(languages: list[str], totals: list, kept: pa.Table, p: Params) -> Model:
    column = {lang: i for i, lang in enumerate(languages)}
    total = {(r["kind"], r["lang"]): r["total"] for r in totals}
    kinds = Counter()
    for r in totals:
        kinds[r["kind"]] = max(kinds[r["kind"]], r["kinds"])
    words: dict[str, int] = {}
    grams: dict[int, dict[str, int]] = {o: {} for o in ORDERS}
    index: list[tuple[int, int, int, int]] = []
    size = 0
    for lang, kind, key, n in zip(*(kept.column(c).to_pylist() for c in ("lang", "kind", "key", "n"))):
        table = words if kind == 0 else grams[kind]
        row = table.get(key)
        if row is None:
            row = table[key] = size
            size += 1
        index.append((row, column[lang], n, kind))
    rows = np.zeros((size, len(languages)))
    kind_of = np.zeros(size, dtype=int)
    for row, col, n, kind in index:
        rows[row, col] = n
        kind_of[row] = kind
    base = np.array([[total.get((k, lang), 0) + p.smoothing * (kinds[k] + 1) for lang in languages]
                     for k in range(max(ORDERS) + 1)])
    return Model(languages, words, grams, np.log((rows + p.smoothing) / base[kind_of]))


class Scorer:
    """Scores texts; keeps one row of log frequencies per word, known or backed off, in a growing table."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index = _Index(self, self.model.words)
        self.table = self.model.rows
        self.used = len(self.model.rows)

    def back_off(self, word: str) -> np.ndarray:
        """The mean row of the word's longest known n-grams; nothing known says nothing."""
        for order in ORDERS:
            known = self.model.grams[order]
            hits = [known[g] for g in grams_of(word, order) if g in known]
            if hits:
                return self.model.rows[hits].mean(axis=0)
        return np.zeros(len(self.model.languages))

    def place(self, word: str) -> int:
        if self.used == len(self.table):
            grown = np.empty((max(1024, 2 * self.used), self.table.shape[1]))
            grown[: self.used] = self.table
            self.table = grown
        self.table[self.used] = self.back_off(word)
        self.index[word] = self.used
        self.used += 1
        return self.used - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        if self.used > len(self.model.rows) + REMEMBERED:
            self._forget()
        at = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        total = self.table.take(at, axis=0).sum(axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


class _Index(dict):
    """Word -> row; a word that is missing is backed off and placed."""

    def __init__(self, scorer: Scorer, known: dict[str, int]):
        super().__init__(known)
        self.scorer = scorer

    def __missing__(self, word: str) -> int:
        return self.scorer.place(word)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # size bounded by Params

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared)
        for batch in pieces_of(batches):
            told = [scorer.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array([t[0] for t in told], pa.string()),
                "score": pa.array([t[1] for t in told], pa.float64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def _scorer(shared) -> Scorer:
    """One per Python worker and model; it goes when the worker drops the broadcast model."""
    if not hasattr(shared, "scorer"):
        shared.scorer = Scorer(shared.value)
    return shared.scorer


def identify_languages(docs: DataFrame, p: Params = Params()) -> DataFrame:
    return predict(docs, fit(docs, p))


def keep_known_language(docs: DataFrame, min_score: float, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is known with at least ``min_score``.

    The scores are computed beside the rows, so nothing is joined or shuffled.
    """
    model = fit(docs, p)
    if not model.languages:
        return docs.where(F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size bounded by Params

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(shared)
        for t in texts:
            yield pd.Series([scorer.predict(x)[1] for x in t], index=t.index, dtype=float)

    return docs.where(score(F.col("text")) >= min_score)

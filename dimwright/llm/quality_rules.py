"""Document quality by weak supervision.

Rules look at simple measures of a text and vote good (+1), bad (-1) or abstain
(0).  No labels are used: expectation-maximisation over the votes of *all*
documents estimates how often each rule speaks on good and on bad documents and
how often it is right, together with the share of good documents.  A document is
kept if its posterior probability of being good reaches ``keep_at`` and the fixed
base rule does not fail it.

The votes of a document are one of at most 3^rules patterns, so the whole corpus
is summarised, without loss, by one count per pattern (a map-side combined
aggregate).  Only that bounded table reaches the driver, where EM runs; the
posterior of every pattern goes back as a small lookup.

Measures (word: ``[^\\x20\\x09-\\x0D]+``): number of words, code points in words,
symbols ``[#*$%&|<>]``, lines that repeat an earlier line of the text (lines with
a word), words inside 8-word windows that occur twice or more, and distinct words,
counted in each block of 20,000 words.

Defined cases: null and empty texts have no words and fail the base rule; an
empty table gives an empty result; repeated rows vote like any other row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import gram_hashes, id_and_text, pieces_of, stored, word_hashes

_SYMBOLS = re.compile(r"[#*$%&|<>]")
REPEAT_WINDOW = 8
#: Distinct words are counted anew in each block of so many words, as their share falls with the length of any text.
VARIETY_BLOCK = 20_000
_SPACE = " \t\n\x0b\x0c\r"
#: Words that are one mark of a table or a menu.
_BARE = frozenset(c.encode() for c in "#*$%&|<>/\\-–—•·=+~_")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_letter_bytes",
            "n_word_bytes", "n_bare")


def measures_of(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    space = sum(map(text.count, _SPACE))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = 0
    if n > REPEAT_WINDOW:
        grams = gram_hashes(word_hashes(words), REPEAT_WINDOW)
        _, which, count = np.unique(grams, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[which] > 1)
        if len(starts):
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + REPEAT_WINDOW, -1)
            repeat = int((np.cumsum(edge)[:n] > 0).sum())
    codes = np.frombuffer(raw, dtype=np.uint8)
    letters = int(((codes | 32) - 97 < 26).sum() + (codes > 127).sum())
    bare = sum(map(_BARE.__contains__, words))
    distinct = sum(len(set(words[at : at + VARIETY_BLOCK])) for at in range(0, n, VARIETY_BLOCK))
    symbols = len(_SYMBOLS.findall(text))
    return n, len(text) - space, symbols, dup, repeat, distinct, lines, letters, len(raw) - space, bare


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, *MEASURES) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            rows = np.array([measures_of(t) for t in batch.column("text").to_pylist()], dtype=np.int64)
            cols = {m: pa.array(rows[:, i].copy()) for i, m in enumerate(MEASURES)}
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **cols})

    return id_and_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, F.lit(-1))
    return vote.when(good, F.lit(1)).otherwise(F.lit(0)) if good is not None else vote.otherwise(F.lit(0))


def votes() -> dict[str, Column]:
    """Each rule as a vote over the measures.

    Most rules look for one kind of damage and have nothing to say about texts
    without it; if they praised those, every kind of damage would be outvoted by
    the rules for the other kinds.  Only plain prose is a reason to vote good.
    """
    c = F.col
    words = F.greatest(c("n_words"), F.lit(1))
    return {
        "short": _vote(c("n_words") < 20),
        "word_length": _vote(~(c("word_chars") / words).between(3, 10)),
        "symbols": _vote(c("n_symbols") * 10 > words),
        "bare_marks": _vote(c("n_bare") * 10 > words),
        "dup_lines": _vote(c("n_dup_lines") * 10 > c("n_lines") * 3),
        "repeats": _vote(c("n_repeat_words") * 10 > words * 2),
        "variety": _vote(c("n_distinct") * 20 < words),
        "letters": _vote(c("n_letter_bytes") * 10 < c("n_word_bytes") * 8,
                         c("n_letter_bytes") * 100 >= c("n_word_bytes") * 93),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9,
        prior_good: float = 0.85) -> tuple[np.ndarray, dict]:
    """EM over vote patterns.

    Per rule and class the probabilities of the three votes are estimated, with a
    fixed number of pseudo-votes (a share of the corpus) that favour rules being
    right; they also settle which of the two classes is the good one.  Returns the
    posterior of good for each pattern and the estimates.
    """
    total = counts.sum()
    votes_ = np.array([-1, 0, 1])
    one_hot = (patterns[:, :, None] == votes_).astype(float)  # pattern x rule x vote
    pseudo = 0.01 * total + 1.0
    believed = {1: np.array([0.05, 0.25, 0.70]), 0: np.array([0.45, 0.35, 0.20])}
    chance = {k: np.tile(v, (patterns.shape[1], 1)) for k, v in believed.items()}
    good, old = prior_good, -np.inf
    for _ in range(rounds):
        logs = {k: (one_hot * np.log(chance[k])).sum(axis=(1, 2)) + np.log(good if k else 1 - good) for k in (0, 1)}
        top = np.logaddexp(logs[0], logs[1])
        posterior = np.exp(logs[1] - top)
        likelihood = float((counts * top).sum() / max(total, 1))
        if likelihood - old < tolerance:
            break
        old = likelihood
        for k, share in ((1, counts * posterior), (0, counts * (1 - posterior))):
            votes_k = (one_hot * share[:, None, None]).sum(axis=0)
            chance[k] = (votes_k + pseudo * believed[k]) / (share.sum() + pseudo)
        good = float((counts @ posterior + prior_good * pseudo) / (total + pseudo))
    accuracy = good * chance[1][:, 2] + (1 - good) * chance[0][:, 0]
    spoken = good * (1 - chance[1][:, 1]) + (1 - good) * (1 - chance[0][:, 1])
    return posterior, {"good": good, "accuracy": accuracy / spoken, "chance": chance}


def quality(docs: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, p_good)."""
    spark = docs.sparkSession
    rules = votes()
    voted = stored(measures(docs).select("doc_id", *MEASURES, *[v.alias(f"vote_{k}") for k, v in rules.items()]),
                   "quality-votes")
    names = [f"vote_{k}" for k in rules]
    table = voted.groupBy(*names).count().collect()  # at most 3 ** rules rows
    schema = ", ".join(f"{n} int" for n in names) + ", p_good double"
    rows = []
    if table:
        patterns = np.array([[r[n] for n in names] for r in table])
        posterior, _ = fit(patterns, np.array([r["count"] for r in table], dtype=float))
        rows = [(*map(int, p), float(g)) for p, g in zip(patterns, posterior)]
    lookup = spark.createDataFrame(rows, schema)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return voted.join(F.broadcast(lookup), names, "left").select(  # at most 3 ** rules rows
        "doc_id", *MEASURES[:5], failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= keep_at)).alias("kept"), "p_good")

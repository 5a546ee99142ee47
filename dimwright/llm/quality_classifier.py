"""Quality classifier: a factorisation machine over words, structure and metadata.

A document's features are

* its words, hashed to ``2 ** WORD_BITS`` buckets, each weighted by its number and
  scaled so that their squares sum to one;
* statistics of its structure (``STRUCTURE``: shares of upper case, digits, symbols
  and so on, repeated words and lines, length), each in one of ``BINS`` steps;
* metadata: the character count that the table declares, in steps of powers of two.

The score is the logistic of ``bias + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``.  The
pairwise sum takes time linear in the features: per factor it is half of
(sum v_i x_i)^2 - sum (v_i x_i)^2.

The model is fitted on a bounded sample, both bounds parameters: about
``docs_per_class`` labelled documents of each class, chosen by a hash of the id,
with at most about ``max_features`` features in all.  Their features are made on
the executors; only those come to the driver, which fits by AdaGrad in small
batches, in an order fixed by the ids.  A feature seen in fewer than
``min_documents`` of them has no weight.  The model has a fixed size (one row of
``1 + factors`` numbers per feature) and is broadcast.  Scoring reads every whole text.

Labels are taken from documents outside the held-out fold; labels, languages, sources
and ids are never inputs of a score.

Defined cases: null and empty texts have no words and are scored by their structure
(a text of length zero); a label that is null is none, and the smallest counts if an
id has several; without labels of both classes every score is the share of good
labels, or 0.5 without any; repeated rows get equal scores; a missing or null
character count is a step of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import forget, pieces_of, ship_package, split_words, stored, text_of, word_hashes

#: Folds by crc32(doc_id as text) mod 3; this one is held out.
FOLDS, HELD_OUT = 3, 1
WORD_BITS = 15
WORDS = 1 << WORD_BITS
BINS = 16
STRUCTURE = ("words", "word_length", "upper", "digits", "symbols", "stops", "other_marks", "non_ascii", "lines",
             "distinct", "top_word", "repeated_next", "equal_lines", "single_letters")
#: Steps of the declared character count: absent, then powers of two.
DECLARED = 34
FEATURES = WORDS + BINS * len(STRUCTURE) + DECLARED
#: Weight of a structure or metadata feature beside words whose squares sum to one.
STEP_WEIGHT = 0.5

# Classes of bytes: lower and upper case letters, digits, white space, symbols, stops, other marks, beyond ASCII.
_LOWER, _UPPER, _DIGIT, _SPACE, _SYMBOL, _STOP, _MARK, _HIGH = range(8)
_CLASS = np.full(256, _MARK, dtype=np.uint8)
_CLASS[128:] = _HIGH
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", _LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
                      (b"0123456789", _DIGIT), (b" \t\n\x0b\x0c\r", _SPACE), (b"#*$%&|<>=+~^_@{}[]\\/", _SYMBOL),
                      (b".,;:?!", _STOP)):
    _CLASS[np.frombuffer(_chars, dtype=np.uint8)] = _kind


@dataclass(frozen=True)
class Params:
    docs_per_class: int = 4_000
    max_features: int = 4_000_000
    min_documents: int = 3
    factors: int = 8
    epochs: int = 12
    batch: int = 64
    rate: float = 0.1
    penalty: float = 1e-4
    seed: int = 1


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # one per feature
    factors: np.ndarray  # one row per feature


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the fold of a document is the held-out one; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


# ----------------------------------------------------------------------------
# features
# ----------------------------------------------------------------------------


def _step(x: float) -> int:
    """A share in one of BINS steps, finer near zero."""
    return min(BINS - 1, int(BINS * min(1.0, max(0.0, x)) ** 0.5))


def _log_step(n: float) -> int:
    return min(BINS - 1, int(np.log2(1 + n)))


def structure(text: str, words: list[bytes], hashes: np.ndarray) -> list[int]:
    """Steps of the STRUCTURE statistics of one text."""
    raw = text.encode()
    size, n = max(1, len(raw)), max(1, len(words))
    kinds = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=8)
    letters = max(1, int(kinds[_LOWER] + kinds[_UPPER]))
    _, counts = np.unique(hashes, return_counts=True)
    top = int(counts.max()) if len(counts) else 0
    again = int((hashes[1:] == hashes[:-1]).sum()) if len(hashes) > 1 else 0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    single = sum(map((1).__eq__, map(len, words)))
    return [
        _log_step(len(words)), min(BINS - 1, int((size - kinds[_SPACE]) / n)), _step(kinds[_UPPER] / letters),
        _step(kinds[_DIGIT] / size), _step(kinds[_SYMBOL] / size), _step(kinds[_STOP] / size),
        _step(kinds[_MARK] / size), _step(kinds[_HIGH] / size), _step(len(lines) / n),
        # Distinct words grow more slowly than words, so a share of them would tell the length.
        _step(len(counts) / n**0.8), _step(top / n) if n > 1 else 0, _step(again / n),
        _step(1 - len(set(lines)) / max(1, len(lines))), _step(single / n),
    ]


def features(texts: list[str], declared: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, features and values of some documents: (document, feature) pairs in that order, each once."""
    words = [split_words(t) for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    hashes = word_hashes([w for ws in words for w in ws])
    ends = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(texts)), sizes)
    keys, counts = np.unique(rows * WORDS + (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), return_counts=True)
    row, feature = np.divmod(keys, WORDS)
    norm = np.sqrt(np.bincount(row, weights=counts.astype(float) ** 2, minlength=len(texts)))
    value = counts / norm[row]
    extra = []
    for k, text in enumerate(texts):
        steps = structure(text, words[k], hashes[ends[k] - sizes[k] : ends[k]])
        said = 0 if declared[k] is None or declared[k] < 0 else min(DECLARED - 1, 1 + int(declared[k]).bit_length())
        extra.append([WORDS + BINS * s + x for s, x in enumerate(steps)] + [WORDS + BINS * len(STRUCTURE) + said])
    extra = np.array(extra, dtype=np.int64).reshape(len(texts), -1)
    row = np.concatenate([row, np.repeat(np.arange(len(texts)), extra.shape[1])])
    feature = np.concatenate([feature, extra.ravel()])
    value = np.concatenate([value, np.full(extra.size, STEP_WEIGHT)])
    order = np.argsort(row, kind="stable")
    return row[order], feature[order], value[order]


# ----------------------------------------------------------------------------
# the machine
# ----------------------------------------------------------------------------


def raw_scores(m: Model, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Scores before the logistic of ``n`` rows whose (row, feature, value) entries are sorted by row.

    Every row has entries, so sums over rows are differences of running places.
    """
    if not n:
        return np.zeros(0)
    starts = np.searchsorted(row, np.arange(n))
    scaled = m.factors[feature] * value[:, None]
    of_rows = np.add.reduceat(scaled, starts, axis=0)
    of_squares = np.add.reduceat(scaled * scaled, starts, axis=0)
    linear = np.add.reduceat(m.weights[feature] * value, starts)
    return m.bias + linear + 0.5 * (of_rows * of_rows - of_squares).sum(axis=1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(row: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, p: Params) -> Model:
    """Fit on documents given as entries sorted by row; ``y`` is 0 or 1 per row."""
    n = len(y)
    share = float(y.mean()) if n else 0.5
    rng = np.random.default_rng(p.seed)
    seen = np.bincount(feature, minlength=FEATURES) >= p.min_documents
    weights = np.zeros(FEATURES)
    factors = rng.normal(0, 0.05, (FEATURES, p.factors)) * seen[:, None]
    if not 0 < share < 1:
        return Model(float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -20, 20)), weights, factors * 0)
    bias = float(np.log(share / (1 - share)))
    keep = seen[feature]
    row, feature, value = row[keep], feature[keep], value[keep]
    ends = np.searchsorted(row, np.arange(n + 1))
    past = [1e-8, np.full(FEATURES, 1e-8), np.full((FEATURES, p.factors), 1e-8)]  # AdaGrad's squared gradients
    for _ in range(p.epochs):
        order = rng.permutation(n)
        for at in range(0, n, p.batch):
            docs = order[at : at + p.batch]
            docs = docs[ends[docs + 1] > ends[docs]]
            if not len(docs):
                continue
            take = np.concatenate([np.arange(ends[d], ends[d + 1]) for d in docs])
            sizes = ends[docs + 1] - ends[docs]
            f, x = feature[take], value[take]
            own = np.repeat(np.arange(len(docs)), sizes)
            m = Model(bias, weights, factors)
            error = logistic(raw_scores(m, own, f, x, len(docs))) - y[docs]
            scaled = factors[f] * x[:, None]
            sums = np.add.reduceat(scaled, np.cumsum(sizes) - sizes, axis=0)
            # d score / d v_i = x_i (sum of the row's v_j x_j, without i's own)
            g = error[own] * x
            into = g[:, None] * (sums[own] - scaled)
            touched, where = np.unique(f, return_inverse=True)
            g_w = np.bincount(where, weights=g, minlength=len(touched)) / len(docs) + p.penalty * weights[touched]
            g_v = np.stack([np.bincount(where, weights=into[:, k], minlength=len(touched)) for k in range(p.factors)],
                           axis=1) / len(docs) + p.penalty * factors[touched]
            g_b = float(error.mean())
            past[0] += g_b * g_b
            past[1][touched] += g_w * g_w
            past[2][touched] += g_v * g_v
            bias -= p.rate * g_b / past[0] ** 0.5
            weights[touched] -= p.rate * g_w / np.sqrt(past[1][touched])
            factors[touched] -= p.rate * g_v / np.sqrt(past[2][touched])
    return Model(bias, weights, factors)


# ----------------------------------------------------------------------------
# on tables
# ----------------------------------------------------------------------------


def _inputs(docs: DataFrame, *more: Column) -> DataFrame:
    declared = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(*more, text_of().alias("text"), declared.alias("declared"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches, 256):
        row, feature, value = features(batch.column("text").to_pylist(), batch.column("declared").to_pylist())
        offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
        yield pa.record_batch({
            "id": batch.column("id"), "good": batch.column("good"),
            "feature": pa.ListArray.from_arrays(offsets, pa.array(feature.astype(np.int32))),
            "value": pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.float32)))})


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    ship_package(docs.sparkSession)
    told = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("good"))
    told = told.where(F.col("id").isNotNull() & F.col("good").isin(0, 1) & ~held_out("id"))
    told = told.groupBy("id").agg(F.min("good").alias("good"))
    sizes = {r["good"]: r["count"] for r in told.groupBy("good").count().collect()}  # two rows at most

    def chance(name: str) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(1 << 30)) / (1 << 30)

    share = F.when(F.col("good") == 1, min(1.0, p.docs_per_class / sizes.get(1, 1))).otherwise(
        min(1.0, p.docs_per_class / sizes.get(0, 1)))
    chosen = told.where(chance("quality sample") < share)
    # About 2 * docs_per_class ids: a size bounded by the parameter, so the texts need not be shuffled.
    rows = _inputs(docs, F.col("doc_id").cast("long").alias("id")).join(F.broadcast(chosen), "id")
    made = stored(rows.select("id", "good", "text", "declared").mapInArrow(
        _featured, "id long, good int, feature array<int>, value array<float>"), "quality-features")
    entries = made.agg(F.sum(F.size("feature")).alias("n")).first()["n"] or 0
    if entries > p.max_features:  # very long documents: fewer of them
        made_in = made.where(chance("quality features") < p.max_features / entries)
    else:
        made_in = made
    table = made_in.toArrow().sort_by("id")
    forget(made)
    lists = table.column("feature").combine_chunks()
    if not table.num_rows:
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0), p)
    row = np.repeat(np.arange(table.num_rows), np.diff(lists.offsets.to_numpy()))
    value = table.column("value").combine_chunks().flatten().to_numpy().astype(float)
    return train(row, lists.flatten().to_numpy().astype(np.int64), value, table.column("good").to_numpy().astype(float), p)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # size fixed by FEATURES and Params.factors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, 256):
            entries = features(batch.column("text").to_pylist(), batch.column("declared").to_pylist())
            good = logistic(raw_scores(shared.value, *entries, batch.num_rows))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(good),
                "predicted": pa.array((good >= 0.5).astype(np.int32))})

    rows = _inputs(docs, F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    return score(docs, fit(docs, labels, p))

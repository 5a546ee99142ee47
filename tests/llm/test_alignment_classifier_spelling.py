"""Tokenizer alignment, the quality classifier and spelling variants against brute force."""

import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import PASSAGE, SF, make, sha

from dimwright.llm import quality_classifier as qc
from dimwright.llm import spelling_variants as sv
from dimwright.llm import token_alignment as ta
from dimwright.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES

TOKENIZER_A = tokenizers.Tokenizer.from_file(BYTE_BPE[0])
TOKENIZER_A.encode_special_tokens = True
LIBRARY_B = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
ALIGNER = ta.Aligner(BYTE_BPE[0], PIECE_BPE)
texts = st.text(alphabet=st.one_of(st.sampled_from("aethn  \n\n▁.,'é日😀0123<>|&\t\x00\x85​　\xa0"),
                                   st.characters(exclude_categories=["Cs"])), max_size=60)


# -- alignment ----------------------------------------------------------------------
@lru_cache(maxsize=1)
def _byte_of():
    """Byte-level characters by what the library makes of single bytes (its alphabet, sorted as bytes are)."""
    own = [b for b in range(256) if chr(b).isprintable() and b > 32 and not 127 <= b <= 160 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute_tokens(text):
    """(ids, byte ranges) by A and by B of a space and the text; None if they don't spell it."""
    if not text:
        return None
    want = (" " + text).encode()
    ids_a = TOKENIZER_A.encode(" " + text, add_special_tokens=False).ids
    ids_b = LIBRARY_B.encode(text)
    raw_a = [bytes(_byte_of()[c] for c in TOKENIZER_A.id_to_token(i)) for i in ids_a]
    raw_b = [bytes([int(LIBRARY_B.id_to_piece(i)[3:5], 16)]) if LIBRARY_B.is_byte(i)
             else LIBRARY_B.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(raw_a) != want or b"".join(raw_b) != want:
        return None
    spans = []
    for raw in (raw_a, raw_b):
        at, found = 0, []
        for x in raw:
            found.append((at, at + len(x)))
            at += len(x)
        spans.append(found)
    return ids_a, spans[0], ids_b, spans[1]


def brute_alignment(rows):
    per_doc = []
    for doc_id, text, *_ in rows:
        found = brute_tokens(text)
        if found is None:
            per_doc.append((doc_id, 0, 0, 0, Counter(), ""))
            continue
        ids_a, at_a, ids_b, at_b = found
        cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = [([], []) for _ in cuts]
        for side, (ids, at) in enumerate(((ids_a, at_a), (ids_b, at_b))):
            for i, (_, e) in zip(ids, at):
                groups[bisect_left(cuts, e)][side].append(str(i))
        said = [",".join(a) + "|" + ",".join(b) for a, b in groups]
        links, first = Counter(), 0
        for i, (s, e) in zip(ids_a, at_a):
            while at_b[first][1] <= s:
                first += 1
            for j in range(first, len(ids_b)):
                if at_b[j][0] >= e:
                    break
                links[i, ids_b[j]] += 1
        per_doc.append((doc_id, len(ids_a), len(ids_b), len(cuts), links, sha(";".join(said))))
    docs = Counter(pair for d in per_doc for pair in d[4])
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    return [(d, na, nb, g, sum(links.values()), sum(m for (a, b), m in links.items() if docs[a, b] == most[a]),
             sum(m * docs[p] for p, m in links.items()), h) for d, na, nb, g, links, h in per_doc]


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def check_alignment(got, rows):
    assert sorted(map(str, (tuple(r[c] for c in ALIGNED) for r in got))) == sorted(map(str, brute_alignment(rows)))


@settings(max_examples=400, deadline=None)
@given(st.lists(texts, max_size=3))
def test_parts_equal_whole_texts(some):
    found = ALIGNER.documents(some)
    want = brute_alignment(list(enumerate(some)))
    for k, w in enumerate(want):
        assert tuple(found[c][k].as_py() for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")) == (
            w[1], w[2], w[3], w[4], w[7])


def test_alphabet_is_the_librarys():
    assert {chr_: b for chr_, b in ta.byte_level_alphabet().items()} == _byte_of()
    assert sorted(tokenizers.pre_tokenizers.ByteLevel.alphabet()) == sorted(ta.byte_level_alphabet())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_dividing_finds_every_shared_cut(sizes, rng):
    total = sum(sizes)
    ends_a = np.cumsum(sizes).tolist()
    ends_b = sorted({e for e in range(1, total) if rng.random() < 0.4} | {total})
    groups = ta.divide(np.array(ends_a), np.array(ends_b), np.array([[0, len(ends_a), 0, len(ends_b)]]))
    assert [ends_a[a1 - 1] for _, a1, _, _ in groups] == sorted(set(ends_a) & set(ends_b))
    assert [ends_b[b1 - 1] for _, _, _, b1 in groups] == sorted(set(ends_a) & set(ends_b))
    assert [i for a0, a1, _, _ in groups for i in range(a0, a1)] == list(range(len(ends_a)))
    assert [j for _, _, b0, b1 in groups for j in range(b0, b1)] == list(range(len(ends_b)))
    starts_a, starts_b = [0, *ends_a], [0, *ends_b]
    links = list(zip(*(x.tolist() for x in ta.overlaps(np.array(ends_a), np.array(ends_b)))))
    assert links == [(i, j) for i in range(len(ends_a)) for j in range(len(ends_b))
                     if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]


def test_a_long_interval_without_cuts_is_one_group():
    n = 20_000
    ends_a, ends_b = np.array([*range(2, 2 * n, 2), 2 * n]), np.array([*range(1, 2 * n, 2), 2 * n])
    assert ta.divide(ends_a, ends_b, np.array([[0, n, 0, n + 1]])).tolist() == [[0, n, 0, n + 1]]


def test_alignment(spark, odd, odd_rows, corpus, corpus_rows, none):
    check_alignment(ta.align_tokenizers(odd, BYTE_BPE[0], PIECE_BPE).collect(), odd_rows)
    # Few pairs are broadcast, the others are joined; none; all.
    for heavy in (40, 1 << 20):
        check_alignment(ta.align_tokenizers(corpus, BYTE_BPE[0], PIECE_BPE, heavy=heavy).collect(), corpus_rows)
    check_alignment(QUERIES["op11_token_alignment"](spark, SF).collect(), corpus_rows)
    assert ta.align_tokenizers(none, BYTE_BPE[0], PIECE_BPE).count() == 0


def test_alignment_of_repeated_rows(spark):
    rows = [(1, "the same words here")] * 40 + [(2, "other words"), (None, None), (3, "▁ mark"), (4, "")]
    check_alignment(ta.align_tokenizers(make(spark, rows), BYTE_BPE[0], PIECE_BPE, heavy=3).collect(), rows)


def test_the_table_of_parts_is_bounded():
    """Frequent parts stay, the others are learnt anew; results are the same."""
    own = ta.Aligner(BYTE_BPE[0], PIECE_BPE)
    some = ["some words often words words words often often", "rare parts\nsome unusual ones"]
    first = own.documents(some)
    size = own.bytes
    own.bytes = ta.REMEMBERED + 1
    assert {k: v.to_pylist() for k, v in own.documents(some).items()} == {k: v.to_pylist() for k, v in first.items()}
    assert own.bytes == size
    own.bytes = ta.REMEMBERED + 1
    own.places(["words"])
    assert set(own.place) == {" words", " often"}


# -- quality classifier -----------------------------------------------------------------
def test_pairwise_sum_is_the_double_loop():
    rng = np.random.default_rng(5)
    model = qc.Model(0.3, rng.normal(size=qc.FEATURES), rng.normal(size=(qc.FEATURES, 4)))
    docs = ["a few words, and words again", "", PASSAGE, "MORE!! WORDS!!", "é 日本 😀\nline\nline"]
    row, feature, value = qc.features(docs, [5, None, 400, 0, 12])
    got = qc.raw_scores(model, row, feature, value, len(docs))
    for k in range(len(docs)):
        f, x = feature[row == k], value[row == k]
        assert len(set(f.tolist())) == len(f)
        want = model.bias + float(model.weights[f] @ x)
        for i in range(len(f)):
            for j in range(i + 1, len(f)):
                want += float(model.factors[f[i]] @ model.factors[f[j]]) * x[i] * x[j]
        assert got[k] == pytest.approx(want)


def test_pairs_are_learnt():
    """Good if exactly one of two words occurs: no linear score can tell."""
    rng = random.Random(2)
    docs, y = [], []
    for _ in range(800):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(" ".join(["alpha"] * a + ["beta"] * b + ["gamma", "delta"]))
        y.append(float(a != b))
    row, feature, value = qc.features(docs, [None] * len(docs))
    words_only = feature < qc.WORDS
    m = qc.train(row[words_only], feature[words_only], value[words_only], np.array(y),
                 qc.Params(epochs=60, rate=0.2, penalty=0))
    got = qc.raw_scores(m, row[words_only], feature[words_only], value[words_only], len(docs)) >= 0
    assert (got == np.array(y, dtype=bool)).mean() > 0.98


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(3)
    docs = [" ".join(f"w{rng.integers(60)}" for _ in range(20)) for _ in range(300)]
    y = np.array([float("w1 " in d or "w2 " in d) for d in docs])
    entries = qc.features(docs, [None] * len(docs))

    def loss(m):
        p = qc.logistic(qc.raw_scores(m, *entries, len(docs)))
        return -(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)).mean()

    assert loss(qc.train(*entries, y, qc.Params(epochs=15))) < 0.5 * loss(qc.train(*entries, y, qc.Params(epochs=0)))


def _auc(scores, truth):
    order = np.argsort(np.argsort(scores)) + 1
    pos = np.asarray(truth, dtype=bool)
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op12_quality_classifier"](spark, sf).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    judged = [(r.score, truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    scores, marks, predicted = map(np.array, zip(*judged))
    assert _auc(scores, marks) > 0.9
    assert (predicted == marks).mean() > 0.9


def test_labels_of_the_held_out_fold_and_other_columns_do_not_matter(spark, corpus):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn(
        "quality", qc.F.when(qc.held_out(), 1 - qc.F.col("quality")).otherwise(qc.F.col("quality")))
    junk = corpus.withColumn("lang", qc.F.lit("x")).withColumn("source", qc.F.lit("y"))
    one = {r.doc_id: r.score for r in qc.classify_quality(corpus, labels).collect()}
    two = {r.doc_id: r.score for r in qc.classify_quality(junk, turned).collect()}
    assert one == two


def test_classifier_on_odd_rows(spark, odd, none, odd_rows):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (8, 0), (None, 1), (10, None)], "doc_id long, quality int")
    for told in (labels, empty):
        got = qc.classify_quality(odd, told).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 6}) == 1
        assert qc.classify_quality(none, told).count() == 0
    assert {r.score for r in qc.classify_quality(odd, empty).collect()} == {0.5}
    assert qc.classify_quality(odd.drop("n_chars"), labels).count() == len(odd_rows)


def test_the_sample_is_bounded(spark, corpus):
    labels = corpus.select("doc_id", (qc.F.col("doc_id") % 2).cast("int").alias("quality"))
    sizes = []
    train, qc.train = qc.train, lambda row, f, v, y, p: (sizes.append((len(y), len(f))), train(row, f, v, y, p))[1]
    try:
        qc.fit(corpus, labels, qc.Params(docs_per_class=20, epochs=1))
        qc.fit(corpus, labels, qc.Params(max_features=4_000, epochs=1))
    finally:
        qc.train = train
    assert 15 < sizes[0][0] < 70 and sizes[1][1] < 9_000


# -- spelling variants ----------------------------------------------------------------------
def one_edit(a, b):
    """Whether one code point is inserted, deleted or replaced between ``a`` and ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows):
    words = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if n >= 3 and len(w) >= 5}


def brute_variants(words):
    """Near words by masks: equal with one place masked, or one is the other without a place."""
    masked, near_of = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masked[w[:i] + "*" + w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in words:
                near_of[w].add(less)
                near_of[less].add(w)
    for same in masked.values():
        for w in same:
            near_of[w] |= same - {w}
    out = {}
    for w, n in words.items():
        near = near_of[w]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows, key=str)


VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def variants(got):
    return sorted((tuple(r[c] for c in VARIANT) for r in got), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=12, unique=True))
def test_tiles_find_single_edits(words):
    for size in {len(w) for w in words}:
        full = [w for w in words if len(w) == size]
        shorter = [w for w in words if len(w) == size - 1]
        near, prefix = sv.near_pairs(full, full, shorter, size)
        for i, a in enumerate(full):
            for j, b in enumerate(full + shorter):
                assert near[i, j] == one_edit(a, b), (a, b)
                assert prefix[i, j] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_spelling_variants(spark, odd, odd_rows, corpus, corpus_rows, none):
    assert variants(sv.spelling_variants(odd).collect()) == brute_variants(brute_words(odd_rows))
    want = brute_variants(brute_words(corpus_rows))
    assert len(want) > 1000 and any(r[1] for r in want)
    assert variants(QUERIES["op13_spelling_variants"](spark, SF).collect()) == want
    assert sv.spelling_variants(none).count() == 0


def test_words_of_long_texts_and_chains(spark):
    rng = random.Random(4)
    rows = [(1, "x" * 3000 + " " + "word " * 50), (2, "x" * 3000 + "y"), (None, "X" * 3000), (3, None)]
    rows += [(10 + i, "x" * 3000) for i in range(5)] + [(30 + i, "x" * 2999) for i in range(4)]
    chain = "abcdefgh"
    for k in range(6):  # each link twice as frequent as the one before
        rows.append((100 + k, (chain + " ") * (4 * 2**k)))
        chain = chain[:k] + chr(ord("p") + k) + chain[k + 1 :]
    # One crowded affix: most words share it, and the counts tie.
    crowd = sorted({"intercontin" + "".join(rng.choice("abc") for _ in range(4)) for _ in range(60)})
    rows.append((200, " ".join(crowd * 3)))
    want = brute_variants(brute_words(rows))
    assert any(len(r[0]) == 3000 and r[4] for r in want)
    for tile in (4, sv.TILE):
        assert variants(sv.spelling_variants(make(spark, rows), tile=tile).collect()) == want


def test_stretches_never_cut_a_run():
    was, sv.STRETCH = sv.STRETCH, 7
    try:
        for text in ("", "abc", "abcdefghij klm nop,qrstuvwxyz", "a" * 50, " " * 30, "ab cd ef gh ij"):
            parts = list(sv._stretches(text))
            assert "".join(parts) == text
            assert [r for p in parts for r in sv.RUN.findall(p)] == sv.RUN.findall(text)
    finally:
        sv.STRETCH = was

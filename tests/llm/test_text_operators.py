"""SentencePiece, packing, personal data, language ID and quality rules against brute force."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from llm_cases import PASSAGE, make, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from dimwright.llm import language_id, packing, pii, quality_rules
from dimwright.llm.queries import BYTE_BPE, PIECE_BPE
from dimwright.llm.sentencepiece_bpe import Merger, encode_decode

MERGER = Merger(PIECE_BPE)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
texts = st.text(alphabet=st.one_of(st.sampled_from("aethn  \n▁.,'é日😀0123<>|&\t\x00"), st.characters(exclude_categories=["Cs"])),
                max_size=80)


# -- SentencePiece ----------------------------------------------------------------
@settings(max_examples=300, deadline=None)
@given(texts)
def test_agenda_equals_library(text):
    assert MERGER.encode(text) == LIBRARY.encode(text, add_eos=True)
    assert MERGER.agrees()


def test_agenda_forms_agree():
    rng = random.Random(3)
    for _ in range(300):
        part = "".join(rng.choice("aeinrst▁lo") for _ in range(rng.randrange(1, 60)))
        symbols = [MERGER.symbol[c] for c in part]
        assert MERGER._merge_short(list(symbols)) == MERGER._merge_long(list(symbols))


def test_a_disagreement_is_seen():
    m = Merger(PIECE_BPE)
    m.encode("some words")
    m.fresh_ids[0] = (5, 6)
    assert not m.agrees()


def check_encoding(rows, got):
    want = []
    for doc_id, text, *_ in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids)), True))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_encode_decode(odd, odd_rows, corpus, corpus_rows, none):
    check_encoding(odd_rows, [tuple(r) for r in encode_decode(odd, PIECE_BPE).collect()])
    check_encoding(corpus_rows, [tuple(r) for r in encode_decode(corpus, PIECE_BPE).collect()])
    assert encode_decode(none, PIECE_BPE).count() == 0
    r = encode_decode(odd.where("doc_id = 4"), PIECE_BPE, with_ids=True).first()
    assert (r.ids, r.decoded) == (LIBRARY.encode("a", add_eos=True), "a")


# -- packing ------------------------------------------------------------------------
TOKENS = packing.Tokens(*BYTE_BPE)


PLAIN = tokenizers.Tokenizer.from_file(BYTE_BPE[0])  # with its defaults


def plain_ids(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(texts, st.just("<|endoftext|>"), st.just(" <|endoftext"))).map("".join), max_size=4))
def test_ids_are_those_of_tokenizers(batch):
    assert TOKENS.ids(batch) == [plain_ids(t) for t in batch]


def test_both_libraries_split_the_alike_characters_alike():
    """Each character beside every class of its neighbours; the rank file then decides within a split."""
    alike = [chr(c) for c in range(0x2060) if re.match(f"[{packing.ALIKE}]", chr(c))]
    assert len(alike) > 600
    for c in alike:
        sides = ["a", "é", "1", "²", " ", "\n", "\t", "\xa0", "\x85", "'", "!", "\x00", c]
        text = "".join(f"{x}{c}{y} {c}{x}" for x in sides for y in sides) + f" {c}{c}\n{c} '{c}s"
        assert TOKENS.fast.encode_ordinary(text) == plain_ids(text), hex(ord(c))


def test_an_added_token_in_a_text(spark):
    text = "a <|endoftext|> b"
    assert TOKENS.ids([text]) == [[64, 220, 50256, 275]]
    check_packing([(1, text)], packing.pack_documents(make(spark, [(1, text)]), BYTE_BPE).collect())


def check_packing(rows, got):
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = plain_ids(text or "") + [2]
        first = len(ids) % 1024 or min(len(ids), 1024)
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins), sum(r.length for r in got)


def test_packing(odd, odd_rows, corpus, corpus_rows, none):
    check_packing(odd_rows, packing.pack_documents(odd, BYTE_BPE).collect())
    n, tokens = check_packing(corpus_rows, packing.pack_documents(corpus, BYTE_BPE).collect())
    assert n <= 1.03 * -(-tokens // 1024)
    assert packing.pack_documents(none, BYTE_BPE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1024), max_size=300), st.integers(1, 8))
def test_best_fit_takes_the_tightest_open_bin(lengths, open_bins):
    """Against a plain list of open bins, searched in full."""
    packer = packing.BestFit(1024, open_bins)
    free: dict[int, int] = {}
    for length in lengths:
        number, offset = packer.place(length)
        fitting = [f for f in free.values() if f >= length]
        if fitting:
            assert free[number] == min(fitting) and offset == 1024 - free[number]
            free[number] -= length
        else:
            assert offset == 0 and number == packer.made - 1
            free[number] = 1024 - length
        if not free[number]:
            del free[number]
        if len(free) > open_bins:  # the fullest closes; of equals any
            open_now = {b for held in packer.by_free for b in held}
            (closed,) = free.keys() - open_now
            assert free[closed] == min(free.values())
            del free[closed]
        assert {b for held in packer.by_free for b in held} == free.keys()


# -- personal data ---------------------------------------------------------------------
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_by_regex(text):
    return sorted((m.start(), list(BASE).index(k), k, m.end()) for k, p in BASE.items()
                  for m in re.finditer(p, text) if passes(k, m.group()))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab@.-+()0123456789 %_é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    got = [(s.start, pii.BASE_KINDS.index(s.kind), s.kind, s.end) for s in pii.find_spans(text) if s.kind in BASE]
    assert got == base_by_regex(text)


def test_personal_data(odd, odd_rows, corpus, corpus_rows, none):
    for rows, df in ((odd_rows, odd), (corpus_rows, corpus)):
        want = []
        for doc_id, text, *_ in rows:
            spans = base_by_regex(text) if text and len(text) < 200_000 else []
            n = Counter(k for _, _, k, _ in spans)
            want.append((doc_id, *(n[k] for k in BASE), sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans))))
        got = [tuple(r)[:6] for r in pii.personal_data(df).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert pii.personal_data(none).count() == 0


def test_added_kinds_need_a_checksum_or_context():
    kinds = lambda t: [s.kind for s in pii.find_spans(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00.") == ["iban"]
    assert kinds("code DE88 3704 0044 0532 0130 00.") == []
    assert kinds("ssn 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("phone: 555-123-4567") == ["local_phone"] and kinds("see 555-123-4567") == []
    low, high = (pii.find_spans(t)[0].score for t in ("4539148803436467", "credit card 4539148803436467"))
    assert pii.THRESHOLD <= low < high <= 1


def test_iban_before_words_in_capitals_or_numbers():
    for iban in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO9386011117947"):
        for before, after in (("IBAN ", " BIC COBADEFFXXX"), ("IBAN ", " 2024 EUR"), ("", ""), ("REF 1 AB12 ", " OK")):
            spans = [s for s in pii.find_spans(before + iban + after) if s.kind == "iban"]
            assert [(s.start, s.end) for s in spans] == [(len(before), len(before + iban))]


def test_scans_are_linear():
    start = time.time()
    for unit in ("7", "7.", "7 ", "+7", "a", "a@", "a.", "A9", "7-", "@a.", "+7("):
        pii.find_spans(unit * 100_000)
    assert time.time() - start < 30


def test_many_spans_are_linear():
    start = time.time()
    for unit in ("1.2.3.4 ssn 123-45-6789 ", "call 030 123 4567 or a@b.c ", "ssn 123-45-6789 "):
        text = unit * 20_000
        spans = pii.find_spans(text)
        assert len(spans) >= 20_000
    assert time.time() - start < 60


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", "ssn 123-45-6789", "a@b.c", " ", "+49 30 123456-78-9012", "030 123 4567", "-", "phone "]),
                max_size=12).map("".join))
def test_added_spans_do_not_touch_base_spans(text):
    spans = pii.find_spans(text)
    base = [s for s in spans if s.kind in pii.BASE_KINDS]
    for s in spans:
        if s.kind not in pii.BASE_KINDS:
            assert not any(s.start < b.end and b.start < s.end for b in base)
    added = [a for a in pii._added(text) if not any(a[1] < b.end and b.start < a[2] for b in base)]
    assert {(s.kind, s.start, s.end) for s in spans if s.kind not in pii.BASE_KINDS} <= {a[:3] for a in added}


def test_mask(odd, none):
    out = {r.doc_id: r for r in pii.mask(odd).collect()}
    assert out[16].text == "mail [EMAIL] from [IP], card [CARD], call [PHONE]"
    assert out[16].n_chars == len(out[16].text) and out[1].text is None and out[1].n_chars is None
    assert pii.mask(odd).columns == odd.columns and pii.mask(none).count() == 0
    assert out[5].text == PASSAGE


# -- language ID --------------------------------------------------------------------------
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in told if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in told if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in told)


def brute_languages(rows, p):
    """Word and n-gram frequencies by plain dictionaries; a prediction per row."""
    learn = [(t, lang) for i, t, lang in rows if lang is not None and t is not None
             and zlib.crc32(("" if i is None else str(i)).encode()) % 4 != 2]
    langs = sorted({lang for _, lang in learn})
    n = defaultdict(Counter)  # (kind, lang) -> counts
    for text, lang in learn:
        for word in language_id.words_of(text):
            n[0, lang][word] += 1
            for order in language_id.ORDERS:
                marked = f"<{word}>" if order > 1 else word
                n[order, lang].update(marked[i : i + order] for i in range(len(marked) - order + 1))
    known = {}
    for kind in (0, *language_id.ORDERS):
        share = (p.max_grams if kind else p.max_words) // len(langs)
        keys = set()
        for lang in langs:
            ranked = sorted(((-m, k) for k, m in n[kind, lang].items() if kind or m > 1), key=lambda r: (r[0], r[1].encode()))
            keys |= {k for _, k in ranked[:share]}
        size = max(len(n[kind, lang]) for lang in langs)
        known[kind] = {k: np.array([np.log((n[kind, lang][k] + p.smoothing) / (n[kind, lang].total() + p.smoothing * (size + 1)))
                                    for lang in langs]) for k in keys}
    out = []
    for _, text, _ in rows:
        total, words = np.zeros(len(langs)), language_id.words_of(text or "")
        for word in words:
            if word in known[0]:
                total += known[0][word]
                continue
            for order in language_id.ORDERS:
                marked = f"<{word}>" if order > 1 else word
                hits = [known[order][g] for g in (marked[i : i + order] for i in range(len(marked) - order + 1)) if g in known[order]]
                if hits:
                    total += np.mean(hits, axis=0)
                    break
        best = int(total.argmax())
        out.append((langs[best], 1 / np.exp(total - total[best]).sum()) if words else ("und", 0.0))
    return out


def test_language_against_brute_force(spark, corpus, corpus_rows):
    p = language_id.Params(docs_per_language=10**9, max_words=400, max_grams=200)
    got = {r.doc_id: r for r in language_id.identify_languages(corpus, p).collect()}
    for (doc_id, *_), (lang, score) in zip(corpus_rows, brute_languages(corpus_rows, p)):
        assert got[doc_id].lang_pred == lang and got[doc_id].score == pytest.approx(score, abs=1e-9)


def test_rare_languages_keep_their_words(spark):
    """One language with most documents, and very many others with a few: all can be predicted."""
    rng = random.Random(12)
    text = lambda k: " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{rng.choice('xyzuvw')}{rng.choice('aeiou')}" for _ in range(12))
    rows = [(i, " ".join(rng.choice(["the", "of", "and"]) + rng.choice("abcdefgh") for _ in range(30)), "hot") for i in range(300)]
    rows += [(1000 + 10 * k + j, text(k), f"l{k:03}") for k in range(520) for j in range(4)]
    got = {r.doc_id: r.lang_pred for r in language_id.identify_languages(
        make(spark, rows), language_id.Params(max_words=6_000, max_grams=6_000)).collect()}
    right = [got[i] == lang for i, _, lang in rows if i >= 1000]
    assert sum(right) > 0.95 * len(right) and len({got[i] for i, *_ in rows}) > 510


def test_words_keep_their_marks():
    assert language_id.words_of("हिन्दी में é́a x1y") == ["हिन्दी", "में", "é́a", "x", "y"]


def test_language_does_not_learn_from_the_held_out_fold(spark):
    rows = [(i, "seulement ici", "xx") if zlib.crc32(str(i).encode()) % 4 == 2 else (i, "only there", "en")
            for i in range(40)]
    assert {r.lang_pred for r in language_id.identify_languages(make(spark, rows)).collect()} == {"en"}


def test_language_defined_cases(spark, odd, odd_rows, none):
    got = language_id.identify_languages(odd).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        text = dict((i, t) for i, t, *_ in odd_rows)[r.doc_id] if r.doc_id is not None else "x"
        has_letter = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not has_letter)
        assert r.lang_pred in {"und", "en", "fr", "de"}
    assert language_id.identify_languages(none).count() == 0
    unlabelled = language_id.identify_languages(make(spark, [(1, "some text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def test_backoff_takes_the_longest_known_grams():
    grams = {5: {}, 4: {"<abc": 1}, 3: {"abc": 2}, 2: {}, 1: {"z": 3}}
    model = language_id.Model(["a", "b"], {"word": 0}, grams, np.array([[0.0, -9], [-1, -2], [-8, -1], [-5, -4]]))
    scorer = language_id.Scorer(model)
    assert scorer.back_off("abcz").tolist() == [-1, -2]
    assert scorer.back_off("xabc").tolist() == [-8, -1]
    assert scorer.back_off("zz").tolist() == [-5, -4]
    assert scorer.back_off("q").tolist() == [0, 0]
    assert scorer.predict("word word abcz")[0] == "a"


# -- quality rules ----------------------------------------------------------------------------
def brute_measures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            repeat.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


def test_quality_measures(odd, odd_rows, corpus, corpus_rows, none):
    for rows, df in ((odd_rows, odd), (corpus_rows, corpus)):
        want = []
        for doc_id, text, *_ in rows:
            m = brute_measures(text or "")
            want.append((doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
        got = quality_rules.quality(df).collect()
        assert sorted(str(tuple(r)[:7]) for r in got) == sorted(map(str, want))
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.quality(none).count() == 0


def test_em_finds_accuracies_without_labels():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    right = [0.95, 0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(rng.random(len(truth)) < 0.3, 0, np.where((rng.random(len(truth)) < a) == truth, 1, -1))
                      for a in right], axis=1)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, found = quality_rules.fit(patterns, counts.astype(float))
    assert abs(found["good"] - 0.8) < 0.05
    assert found["accuracy"].argsort().tolist()[::-1][:3] == [0, 1, 2]
    kept = posterior[which.ravel()] >= 0.5
    majority = votes.sum(axis=1) >= 0
    assert (kept == truth).mean() >= (majority == truth).mean()


def test_quality_keeps_clean_and_drops_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(2)
    junk = [(10_000 + i, " ".join(f"{rng.choice('abc')}{rng.randrange(9999)}###" + "$%&" * 3 for _ in range(200)))
            for i in range(40)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(junk, "doc_id long, text string"))
    got = {r.doc_id: r for r in quality_rules.quality(both).collect()}
    assert not any(got[i].kept for i, _ in junk)
    clean = [r for r in got.values() if r.doc_id < 10_000 and not r.base_failed and r.n_symbols < 5 and r.n_words > 50]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)


def test_long_texts_of_few_words_are_voted_bad(spark):
    """Drawn at random from 50 words: the vote does not depend on the length; long prose of many words is not bad."""
    rng = random.Random(4)
    few, many = ([f"word{chr(97 + i % 26)}{i}" for i in range(n)] for n in (50, 9000))
    rows = [(n, " ".join(rng.choices(few, k=n))) for n in (19_999, 20_000, 20_001, 90_000)]
    rows.append((1, " ".join(rng.choices(many, k=90_000))))
    votes = quality_rules.measures(make(spark, rows)).select("doc_id", quality_rules.votes()["variety"].alias("v"))
    assert {r.doc_id: r.v for r in votes.collect()} == {n: -1 for n, _ in rows[:-1]} | {1: 0}

"""Repeated-passage removal with Aho-Corasick automata.

A window is 20 consecutive words.  Every word covered by a window whose word
sequence also starts earlier (in a smaller ``doc_id``, or earlier in the same
document) is removed; windows are judged on the input.

1. *Phrases.*  Each window contains thirteen 8-word phrases; the one with the
   smallest hash is its phrase.  Equal windows choose equal phrases, and neighbouring
   windows mostly share theirs, so about one phrase in seven is chosen.  Chosen
   phrases are counted over the corpus; those chosen once cannot lie in a repeated
   window and drop out.
2. *Recurring passages* are the phrases left.  Each document gets the list of its own.
3. *Automata.*  The documents are cut into shards (slices of Arrow batches).
   The recurring phrases of a shard's documents are compiled into one Aho-Corasick
   automaton over word codes, and all documents of the shard are streamed
   through it to locate every occurrence.  A phrase reaches only shards
   that hold it, so each document is streamed once however many phrases there are.
4. *Exact check.*  Only windows around located phrases are compared over the corpus,
   by 96-bit hashes of all their words: an aggregate finds the first document of
   each, and that document gets the window in its list of first occurrences.
5. Every document is streamed once more: a window around one of its phrases that is
   not in its list of first occurrences, or that it had before, is removed.

Phrase counts and first documents are sums and minima, combined map-side, so a
passage that a third of all documents share is no hot key.

Defined cases: a null or blank text has no words; texts under 20 words lose none;
a null ``doc_id`` counts as later than every other, such rows being ordered by a
hash of the text; rows that repeat a document (id and text) do not count as
earlier than each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, compress

import ahocorasick
import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import (
    LAST_ID, forget, gram_hashes, id_and_text, mix, pieces_of, split_words, stored, word_hashes,
)

WINDOW, PHRASE = 20, 8
_PER_WINDOW = WINDOW - PHRASE + 1
#: Multiplier of the second window hash.
_SECOND = 0xC2B2AE3D27D4EB4F
_DOC = ["rank_id", "text_key"]


def _ranked(docs: DataFrame) -> DataFrame:
    """(doc_id, rank_id, text_key, text): rank_id and text_key order documents, also where the id is null."""
    return id_and_text(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("rank_id"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).alias("text_key"), "text")


def chosen_phrases(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the phrases chosen by the windows of one document."""
    phrases = gram_hashes(hashes, PHRASE)
    if len(hashes) < WINDOW:
        return np.empty(0, dtype=np.int64), phrases[:0]
    # mix() orders phrases unlike their hash values, which go into the tables
    lowest = sliding_window_view(mix(phrases), _PER_WINDOW).argmin(axis=1)
    starts = np.unique(lowest + np.arange(len(lowest)))
    return starts, phrases[starts]


def phrase_rows(ranked: DataFrame) -> DataFrame:
    """(phrase, rank_id, text_key, n): how often each document chose each of its phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            found, counts, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                words = split_words(text)
                chosen = chosen_phrases(word_hashes(words))[1] if len(words) >= WINDOW else np.empty(0, np.uint64)
                phrases, n = np.unique(chosen, return_counts=True)
                found.append(phrases)
                counts.append(n)
                sizes.append(len(phrases))
            owner = {c: np.repeat(batch.column(c).to_numpy(), sizes) for c in _DOC}
            yield pa.record_batch({
                "phrase": pa.array(np.concatenate(found).view(np.int64)),
                **{c: pa.array(v, pa.int64()) for c, v in owner.items()},
                "n": pa.array(np.concatenate(counts).astype(np.int32))})

    return ranked.select(*_DOC, "text").mapInArrow(run, "phrase long, rank_id long, text_key long, n int")


#: Characters of word codes; few of them keep every automaton node small.
_DIGITS = "".join(chr(c) for c in range(48, 112))


def word_codes(words: list[bytes]) -> tuple[dict[bytes, str], str]:
    """Codes of equal width for the distinct ``words``, and the code for any other word."""
    width = 3 if len(words) < len(_DIGITS) ** 3 else 5
    base = len(_DIGITS)
    powers = [base**k for k in reversed(range(width))]
    codes = {w: "".join(_DIGITS[n // p % base] for p in powers) for n, w in enumerate(words)}
    return codes, "\x7f" * width


class Shard:
    """The automaton of a slice of documents, and the windows that it locates in each."""

    def __init__(self, texts: list[str], lists: list[np.ndarray | None]):
        self.words = [split_words(t) for t in texts]
        self.lists = [own if own is not None and len(own) else None for own in lists]
        self.hashes = [None if own is None else word_hashes(w) for w, own in zip(self.words, self.lists)]
        phrases: dict[int, list[bytes]] = {}
        for words, hashes, own in zip(self.words, self.hashes, self.lists):
            if own is None:
                continue
            starts, chosen = chosen_phrases(hashes)
            listed = np.isin(chosen, own)
            for start, phrase in zip(starts[listed].tolist(), chosen[listed].tolist()):
                if phrase not in phrases:
                    phrases[phrase] = words[start : start + PHRASE]
        self.codes, self.other = word_codes(list(dict.fromkeys(chain.from_iterable(phrases.values()))))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, words in enumerate(phrases.values()):
            self.automaton.add_word("".join([self.codes[w] for w in words]), n)
        if phrases:
            self.automaton.make_automaton()
        self.phrase_of = np.fromiter(phrases, dtype=np.uint64, count=len(phrases))

    def located(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``windows_around`` every occurrence of the document's phrases, located by the automaton."""
        if self.lists[i] is None:
            return windows_around(len(self.words[i]), None, np.empty(0, np.int64))
        code, other, width = self.codes.get, self.other, len(self.other)
        coded = "".join([code(w, other) for w in self.words[i]])
        hits = np.array(list(self.automaton.iter(coded)), dtype=np.int64).reshape(-1, 2)
        hits = hits[(hits[:, 0] + 1) % width == 0]  # matches of whole words
        own = np.isin(self.phrase_of[hits[:, 1]], self.lists[i])
        starts = (hits[own, 0] + 1) // width - PHRASE
        return windows_around(len(self.words[i]), self.hashes[i], starts)


def windows_around(n_words: int, hashes: np.ndarray | None, phrase_starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, first hash, second hash) of every window that holds a phrase beginning at one of ``phrase_starts``."""
    n = n_words - WINDOW + 1
    if hashes is None or n < 1 or not len(phrase_starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.clip(phrase_starts - (WINDOW - PHRASE), 0, n), 1)
    np.add.at(edge, np.clip(phrase_starts + 1, 0, n), -1)
    at = np.flatnonzero(np.cumsum(edge)[:n])
    second = gram_hashes(hashes, WINDOW, _SECOND) >> np.uint64(32)
    return at, gram_hashes(hashes, WINDOW)[at], second[at]


def _lists(column: pa.Array) -> list[np.ndarray | None]:
    return [x.values.to_numpy().view(np.uint64) if x.is_valid else None for x in column]


def window_rows(listed: DataFrame) -> DataFrame:
    """(w1, w2, rank_id, text_key): the distinct windows located in each document of (.., text, phrases)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            shard = Shard(batch.column("text").to_pylist(), _lists(batch.column("phrases")))
            firsts, seconds, sizes = [], [], []
            for i in range(batch.num_rows):
                _, w1, w2 = shard.located(i)
                w1, index = np.unique(w1, return_index=True)
                firsts.append(w1)
                seconds.append(w2[index])
                sizes.append(len(w1))
            yield pa.record_batch({
                "w1": pa.array(np.concatenate(firsts).view(np.int64)),
                "w2": pa.array(np.concatenate(seconds).astype(np.uint32).view(np.int32)),
                **{c: pa.array(np.repeat(batch.column(c).to_numpy(), sizes), pa.int64()) for c in _DOC}})

    return listed.select(*_DOC, "text", "phrases").mapInArrow(run, "w1 long, w2 int, rank_id long, text_key long")


def first_windows(windows: DataFrame) -> DataFrame:
    """(rank_id, text_key, firsts): for each document the windows that it is the first to hold."""
    unnamed = F.col("rank_id") == LAST_ID
    firsts = windows.groupBy("w1", "w2").agg(
        F.min("rank_id").alias("rank_id"), F.min(F.when(unnamed, F.col("text_key"))).alias("_key"))
    owned = firsts.select("w1", "w2", "rank_id", F.when(unnamed, F.col("_key")).otherwise(F.lit(0)).alias("text_key"))
    return owned.groupBy(*_DOC).agg(
        F.collect_list("w1").alias("first1"), F.collect_list("w2").alias("first2"))


def _joint(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """One value for both hashes of a window, for use inside one document."""
    return mix(w1 ^ mix(w2 + np.uint64(1)))


def covered(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge)[:n] > 0


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, and on request ``kept_text``."""
    ranked = _ranked(docs)
    rows = stored(phrase_rows(ranked), "phrases")
    recurring = rows.groupBy("phrase").agg(F.sum("n").alias("times")).where("times > 1").select("phrase")
    lists = stored(
        rows.join(recurring, "phrase", "left_semi").groupBy(*_DOC).agg(F.collect_set("phrase").alias("phrases")),
        "phrase-lists")
    forget(rows)
    windows = window_rows(ranked.join(lists.hint("shuffle_hash"), _DOC))
    notes = stored(lists.join(first_windows(windows), _DOC, "left"), "passages")
    forget(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            n_words, n_removed, shas, texts = [], [], [], []
            lists_ = _lists(batch.column("phrases"))
            first1, first2 = batch.column("first1"), batch.column("first2")
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = kept = split_words(text)
                if lists_[i] is not None:
                    hashes = word_hashes(words)
                    # The phrases that the automaton has located, found again by their hashes.
                    starts = np.flatnonzero(np.isin(gram_hashes(hashes, PHRASE), lists_[i]))
                    at, w1, w2 = windows_around(len(words), hashes, starts)
                    here = _joint(w1, w2)
                    stays = np.zeros(len(at), dtype=bool)
                    stays[np.unique(here, return_index=True)[1]] = True
                    if first1[i].is_valid:
                        own1 = first1[i].values.to_numpy().view(np.uint64)
                        own2 = first2[i].values.to_numpy().view(np.uint32).astype(np.uint64)
                        stays &= np.isin(here, _joint(own1, own2))
                    else:
                        stays[:] = False
                    gone = covered(len(words), at[~stays])
                    kept = list(compress(words, (~gone).tolist()))
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                text = b" ".join(kept)
                shas.append(hashlib.sha256(text).hexdigest())
                texts.append(text.decode() if with_text else None)
            out = {
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
            yield pa.record_batch(out | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    joined = ranked.join(notes.hint("shuffle_hash"), _DOC, "left")
    return joined.select("doc_id", "text", "phrases", "first1", "first2").mapInArrow(run, schema)

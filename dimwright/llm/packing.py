"""Best-fit packing of tokenised documents into sequences of at most ``capacity`` tokens.

1. Every document is tokenised and an end id added; only documents longer than a
   sequence are cut, into full pieces after a shorter first one.  Pieces are rows
   of a few numbers; token ids stay behind.
2. Pieces are dealt by hash to waves of about ``WAVE`` pieces, and waves to tasks.
3. In each task an online best-fit packer takes the pieces wave by wave, long ones
   of a wave first, so the short ones fill what the long ones left open.  Its
   open sequences are kept by free space, and an integer used as a bitset tells
   which free spaces exist, so the tightest fit is found with a few bit
   operations.  The number of open sequences is fixed; when one too many is open,
   the fullest is closed first.  A task holds the open sequences only.

Ids are those of ``tokenizers`` with its defaults.  Texts whose characters are all of
``ALIKE`` and that hold no added token's string come from ``tiktoken`` with the
rank file of the same vocabulary, which encodes several times faster: tests
compare the two libraries on every character of that range and between all its
classes, so both split such texts alike.  All other texts go through ``tokenizers``.

Defined cases: null and empty texts have the end id only; the string of an added
token in a text is that token, as ``tokenizers`` has it; repeated rows are packed
like any other row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import id_and_text, pieces_of, stored

CAPACITY = 1024
#: Sequences open at once in one task.
OPEN_BINS = 512
#: Pieces of one wave, and waves of one task.
WAVE, WAVES_PER_TASK = 2_000, 50
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECE}, sequence_id long, offset long"
#: Task in the high bits, the task's own sequence number in the low ones.
_SEQUENCE_BITS = 40


#: Characters that both libraries class alike: Latin letters, general punctuation, controls.
ALIKE = r"\x00-\u024F\u2010-\u2027\u2030-\u205E"


class Tokens:
    """Ids of texts as ``tokenizers`` gives them, by the rank file where that is the same."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.reference = tokenizers.Tokenizer.from_file(json_path)
        added = [re.escape(t.content) for t in self.reference.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([f"[^{ALIKE}]", *added]))

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.reference.encode(t, add_special_tokens=False).ids if self.other.search(t)
                else self.fast.encode_ordinary(t) for t in texts]


@lru_cache(maxsize=2)
def tokens(json_path: str, ranks_path: str, pattern: str) -> Tokens:
    """One per Python worker."""
    return Tokens(json_path, ranks_path, pattern)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: full ones after a first that may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, files: tuple[str, str, str], end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens(*files)
        for batch in pieces_of(batches):
            rows, counts = [], []
            for ids in tok.ids(batch.column("text").to_pylist()):
                ids.append(end_id)
                raw = np.array(ids, dtype="<u4").tobytes()
                parts = cut(len(ids), capacity)
                counts.append(len(parts))
                rows += [(k, at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])) for k, (at, n) in enumerate(parts)]
            cols = np.array(rows, dtype=np.int64).reshape(-1, 4).T
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(np.repeat(np.arange(batch.num_rows), counts))),
                "piece": pa.array(cols[0].astype(np.int32)),
                "start": pa.array(cols[1].copy()), "length": pa.array(cols[2].copy()),
                "ids_crc32": pa.array(cols[3].copy())})

    return id_and_text(docs).mapInArrow(run, _PIECE)


class BestFit:
    """Online best fit with a fixed number of open bins."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit f is set if an open bin has f free
        self.open = 0
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece: the open bin with the least sufficient space, or a new one."""
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            held = self.by_free[free]
            number = held.pop()
            if not held:
                self.spaces &= ~(1 << free)
            self.open -= 1
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.spaces |= 1 << left
            self.open += 1
            if self.open > self.open_bins:
                self._close_fullest()
        return number, self.capacity - free

    def _close_fullest(self) -> None:
        least = (self.spaces & -self.spaces).bit_length() - 1
        self.by_free[least].pop()
        if not self.by_free[least]:
            self.spaces &= ~(1 << least)
        self.open -= 1


def pack(table: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.  ``table`` should be a stored one: it is counted first."""
    waves = max(1, -(-table.count() // WAVE))
    # Piece number and checksum are part of the hash, so many rows of one document spread as well.
    wave = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(waves))
    dealt = table.withColumn("_wave", wave).withColumn("_task", F.floor(F.col("_wave") / WAVES_PER_TASK))
    dealt = dealt.repartition(-(-waves // WAVES_PER_TASK), "_task").sortWithinPartitions(
        "_task", "_wave", F.desc("length"), "ids_crc32", "doc_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, current = None, None
        for batch in batches:
            where, lengths = batch.column("_task").to_pylist(), batch.column("length").to_pylist()
            ids, offsets = [], []
            for task, length in zip(where, lengths):
                if task != current:  # a partition may hold several tasks
                    packer, current = BestFit(capacity, open_bins), task
                number, offset = packer.place(length)
                ids.append((task << _SEQUENCE_BITS) + number)
                offsets.append(offset)
            yield pa.record_batch({
                **{c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                "sequence_id": pa.array(ids, pa.int64()), "offset": pa.array(offsets, pa.int64())})

    return dealt.mapInArrow(run, _PACKED)


def pack_documents(docs: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    return pack(stored(pieces(docs, files), "pieces"))

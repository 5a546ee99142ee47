"""Encoding and decoding with a merge-type SentencePiece vocabulary.

``Merger`` encodes with a score-ordered agenda: every adjacent symbol pair that
forms a piece waits in a heap by (score, position); the best one is merged and
its new neighbours join the agenda, until it is empty.  Symbols that are no piece
fall back to their UTF-8 bytes.

Merging never crosses a pair of adjacent characters that no piece contains, so
a text is cut at white space and at such pairs, and the parts - mostly words -
are encoded once and remembered in a bounded table per Python worker.

The library checks the agenda in every Arrow batch: all parts that a batch has
met for the first time are encoded by it as well, in one call.  Should
they ever differ, the batch's texts take the library's ids and ``agenda_ok`` is
false.  Decoding is the library's.

Defined cases: null and empty texts have the end id only and decode to the empty
text; texts may be of any length; repeated rows and rows without an id are
encoded like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from operator import add

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from dimwright.llm.common import id_and_text, pieces_of

#: The library's mark for a space.
SPACE = "▁"
#: Parts remembered per Python worker (about 250 bytes each).
REMEMBERED = 700_000


_NO_PAIR = 1 << 62


class _Known(dict):
    """Part -> ids; a part that is missing is encoded and remembered."""

    def __init__(self, owner: "Merger"):
        super().__init__()
        self.owner = owner

    def __missing__(self, part: str) -> tuple[int, ...]:
        return self.owner.first_met(part)


class Merger:
    """Encodes with the agenda; ``library`` is the processor it is checked against."""

    def __init__(self, model_path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.end = sp.eos_id()
        size = sp.get_piece_size()
        pieces = {}
        for i in range(size):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
                continue
            if sp.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not merge-only")
            pieces[sp.id_to_piece(i)] = i
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_fallback = all(sp.is_byte(i) for i in self.byte_ids)
        self.unknown = sp.unk_id()
        self.decimals = [str(i) for i in range(size)]
        # Symbols are pieces, or characters of pieces that are none themselves (ids from ``size`` on).
        symbol = dict(pieces)
        for c in sorted({c for p in pieces for c in p} - symbol.keys()):
            symbol[c] = size + len(symbol)
        self.symbol = symbol
        self.piece_ids = set(pieces.values())
        self.char_of = {i: c for c, i in symbol.items() if len(c) == 1}
        order = {s: k for k, s in enumerate(sorted({-sp.get_score(i) for i in pieces.values()}))}
        #: (left symbol, right symbol) -> place of the joined piece's score (0 is the best), and the piece.
        self.place: dict[tuple[int, int], int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for p, i in pieces.items():
            for at in range(1, len(p)):
                left, right = symbol.get(p[:at]), symbol.get(p[at:])
                if left is not None and right is not None:
                    self.place[left, right] = order[-sp.get_score(i)]
                    self.joined[left, right] = i
        self.inner = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        # A mark after another character is a safe cut if no piece holds that pair.
        if any(b[1] == SPACE and b[0] != SPACE for b in self.inner):
            raise ValueError("a piece has a space after another character")
        self.newline_apart = not any("\n" in p for p in pieces)
        self.known = _Known(self)
        self.fresh: list[str] = []
        self.fresh_ids: list[tuple[int, ...]] = []

    def normalized(self, text: str) -> str:
        return self.library.normalize(text)

    def merge(self, part: str) -> list[int]:
        """Ids of one part, by the agenda."""
        symbols = list(map(self.symbol.get, part))
        if None in symbols:  # a character of no piece: a symbol of its own
            symbols = [-1 - i if s is None else s for i, s in enumerate(symbols)]
        symbols = self._merge_short(symbols) if len(symbols) <= 48 else self._merge_long(symbols)
        if self.piece_ids.issuperset(symbols):
            return symbols
        out: list[int] = []
        for s in symbols:
            if s in self.piece_ids:
                out.append(s)
            elif self.byte_fallback:
                out.extend(self.byte_ids[b] for b in (part[-1 - s] if s < 0 else self.char_of[s]).encode())
            else:
                out.append(self.unknown)
        return out

    def _merge_short(self, symbols: list[int]) -> list[int]:
        """The agenda as a list beside the symbols: entry i is the place of the pair (i, i + 1)."""
        place, joined = self.place, self.joined
        agenda = [place[pair] if pair in place else _NO_PAIR for pair in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == _NO_PAIR:
                break
            i = agenda.index(best)  # the leftmost of equals
            new = symbols[i] = joined[symbols[i], symbols.pop(i + 1)]
            del agenda[i]
            if i:
                pair = symbols[i - 1], new
                agenda[i - 1] = place[pair] if pair in place else _NO_PAIR
            if i < len(agenda):
                pair = new, symbols[i + 1]
                agenda[i] = place[pair] if pair in place else _NO_PAIR
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The agenda as a heap of (place, position); a merged-away pair is skipped when it comes up."""
        place, joined, n = self.place, self.joined, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        gone = [False] * n
        agenda = [(place[a, b], i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (a, b) in place]
        heapq.heapify(agenda)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i]
            if gone[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j] = joined[a, b], True
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (symbols[left], symbols[right]) in place:
                    pair = symbols[left], symbols[right]
                    heapq.heappush(agenda, (place[pair], left, *pair))
        return [s for s, dead in zip(symbols, gone) if not dead]

    def first_met(self, part: str) -> tuple[int, ...]:
        """Encode an unknown part: cut it where no piece can reach across, merge what is left."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        pairs = list(map(add, part, part[1:]))
        if self.inner.issuperset(pairs):
            found = tuple(self.merge(part))
        else:
            cuts = [i for i, pair in enumerate(pairs, 1) if pair not in self.inner]
            found = tuple(chain.from_iterable(
                self._cut_part(part[a:b]) for a, b in zip([0, *cuts], [*cuts, len(part)])))
        self.known[part] = found
        self.fresh.append(part)
        self.fresh_ids.append(found)
        return found

    def _cut_part(self, piece: str) -> tuple[int, ...]:
        """Remembered like any part; the library checks it inside the part that it was cut from."""
        ids = self.known.get(piece)
        if ids is None:
            ids = self.known[piece] = tuple(self.merge(piece))
        return ids

    def parts(self, norm: str) -> list[str]:
        """Cut before every run of space marks (and around newlines, where no piece holds one)."""
        return _NEWLINE_PARTS.findall(norm) if self.newline_apart else _PARTS.findall(norm)

    def encode(self, text: str) -> list[int]:
        if not text:
            return [self.end]
        ids = list(chain.from_iterable(map(self.known.__getitem__, self.parts(self.normalized(text)))))
        ids.append(self.end)
        return ids

    def agrees(self) -> bool:
        """Whether the library encodes the parts met since the last call in the same way."""
        fresh, self.fresh = self.fresh, []
        ids, self.fresh_ids = self.fresh_ids, []
        if not fresh:
            return True
        # Marks become the spaces they stand for; a newline, which no piece holds, keeps parts apart.
        if self.newline_apart:
            told = self.library.encode("\n" + "\n".join(fresh).replace(SPACE, " "))
            each = chain.from_iterable(zip(repeat(self.merge("\n")), ids))
            return told == self.merge(SPACE) + list(chain.from_iterable(each))
        texts = [p.replace(SPACE, " ") for p in fresh]
        return all(self.library.encode(t) == self.merge(self.normalized(t)) for t in texts)


_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NEWLINE_PARTS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


@lru_cache(maxsize=2)
def merger(model_path: str) -> Merger:
    """One per Python worker and model."""
    return Merger(model_path)


def encode_decode(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agenda_ok) of every document, and on request ``ids`` and
    ``decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model_path)
        decode, decimals = m.library.decode, m.decimals
        for batch in pieces_of(batches):
            texts = batch.column("text").to_pylist()
            all_ids = [m.encode(t) for t in texts]
            ok = m.agrees()
            if not ok:
                m.known.clear()
                all_ids = [m.library.encode(t, add_eos=True) for t in texts]
            decoded = [decode(ids) for ids in all_ids]
            shas = [hashlib.sha256(" ".join([decimals[i] for i in ids]).encode()).hexdigest() for ids in all_ids]
            out = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(ids) for ids in all_ids], pa.int64()),
                "ids_sha256": pa.array(shas, pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                "agenda_ok": pa.array([ok] * len(texts), pa.bool_()),
            }
            if with_ids:
                out |= {"ids": pa.array(all_ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            yield pa.record_batch(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agenda_ok boolean"
    return id_and_text(docs).mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))

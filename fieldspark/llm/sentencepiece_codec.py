"""SentencePiece encoding and decoding for merge-type vocabularies.

The method is a score-ordered agenda: all adjacent symbol pairs that form a piece wait in a heap,
the best-scored (then leftmost) pair is merged, and its new neighbours join the heap. What no merge
reaches falls back to its UTF-8 bytes.

An agenda over a whole document would be long, so a text is cut where no merge can ever pass: a
merge across a cut would need a piece that holds the two characters around it side by side. Spaces
become the word mark, which pieces hold only in front, so every space is such a cut, and so is
the change between letters and other characters. Parts repeat, and their ids are kept.

Every new part of an Arrow batch, and the first document of the batch as a whole, is encoded and
decoded by the sentencepiece library too; a difference raises.

Defined cases: a NULL text counts as empty; an empty text has the end id only, and decodes to the
empty text. A NULL doc_id is passed on, repeated rows each give a row, an empty table gives none.
Texts are taken whole, however long. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import kept_in_process, over_batches, texts

MARK = "▁"
# Most parts whose ids a worker process keeps, beyond those of the texts at hand; a full table starts anew with the
# parts it shares with those texts, which are the frequent ones.
KEPT_PARTS = 200_000
# Characters of the texts that are cut before their parts are looked up; a longer text stands alone.
CUT_CHARS = 1 << 20
# Parts up to this many characters share a table; rows of one table, and parts checked in one call.
SHORT, ROWS, TOGETHER = 24, 4_096, 50_000
# No symbol, and the rank of a pair that is no piece.
EMPTY, NEVER = -1, 1 << 40


def _cutter(pieces: Iterable[str]) -> Callable[[str], list[str]]:
    """Cut before word marks and between letters and other characters, which pieces never join."""
    letter = re.compile(r"[^\W\d_]")
    joined = set()
    for piece in pieces:
        for one, other in zip(piece, piece[1:]):
            if other == MARK and one != MARK:
                raise ValueError("pieces that hold a word mark after another character are not supported")
            if one != MARK and bool(letter.match(one)) != bool(letter.match(other)):
                joined |= {c for c in (one, other) if letter.match(c)}
    # Letters that a piece joins to other characters count among the others.
    more = re.escape("".join(sorted(joined)))
    return re.compile(rf"{MARK}*[^\W\d_{more}]+|{MARK}*(?:[^\w{MARK}]|[\d_{more}])+|{MARK}+").findall


class MergeCodec:
    """Encoder and decoder over the pieces of a model file. Built once per worker process."""

    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        as_byte = [i for i in range(size) if self.library.is_byte(i)]
        merged = [
            i for i in range(size)
            if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))
        ]
        self.end = array("i", [self.library.eos_id()]).tobytes()
        self.ids = {names[i]: i for i in merged}
        # A symbol is a piece, or size + code point for a character that is none.
        self.symbol_of = np.arange(size, size + 0x110000, dtype=np.int64)
        for name, i in self.ids.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = i
        self.bytes = [0] * 256
        self.spelled = [b""] * size
        for i in merged:
            self.spelled[i] = names[i].replace(MARK, " ").encode()
        for i in as_byte:
            value = int(names[i][3:-1], 16)
            self.bytes[value], self.spelled[i] = i, bytes([value])
        self._load_merges({i: self.library.get_score(i) for i in merged}, names)
        self.parted = _cutter(self.ids)
        # A character of no piece, which keeps what follows apart from what stands before.
        self.stop = next(c for c in map(chr, range(1, 128)) if not any(c in name for name in self.ids))
        # Ids as 32-bit integers.
        self.parts: dict[str, bytes] = {}

    def _load_merges(self, scores: dict[int, float], names: list[str]) -> None:
        """All symbol pairs that form a piece, by key left * 2^32 + right, with piece and rank.

        Rank 0 has the best score; equal scores share a rank, so that the leftmost pair wins.
        """
        ranked = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = []
        for i, score in scores.items():
            name = names[i]
            for cut in range(1, len(name)):
                sides = [self._symbol(name[:cut]), self._symbol(name[cut:])]
                if None not in sides:
                    pairs.append((sides[0] << 32 | sides[1], i, ranked[score]))
        pairs.sort()
        self.pair_keys, self.pair_pieces, self.pair_ranks = (np.array(column, np.int64) for column in zip(*pairs, strict=True))
        self.merges = {key: (rank, piece) for key, piece, rank in pairs}

    def _symbol(self, name: str) -> int | None:
        return self.ids.get(name, self.size + ord(name) if len(name) == 1 else None)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER where the pair is no piece) and piece of symbol pairs."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], NEVER), self.pair_pieces[at]

    def merge_short(self, parts: list[str]) -> list[list[int]]:
        """The agenda of many short parts at once: one row of symbols and pair ranks each.

        A round merges the best-ranked pair of every row and looks its new neighbours up.
        """
        lengths = np.array([len(part) for part in parts])
        width = int(lengths.max())
        symbols = np.full((len(parts), width + 1), EMPTY)
        symbols[np.arange(width + 1) < lengths[:, None]] = self.symbol_of[
            np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        ]
        ranks, pieces = self._lookup(symbols[:, :-1], symbols[:, 1:])
        done: list[list[int]] = [[]] * len(parts)
        rows = np.arange(len(parts))
        columns = np.arange(width)
        while True:
            best = ranks.argmin(axis=1)
            at = np.arange(len(rows))
            ended = ranks[at, best] == NEVER
            for row, found in zip(rows[ended], symbols[ended].tolist(), strict=True):
                done[row] = self._as_ids(found)
            going = ~ended
            if not going.any():
                return done
            rows, symbols, ranks, pieces, best = rows[going], symbols[going], ranks[going], pieces[going], best[going]
            at = np.arange(len(rows))
            merged = pieces[at, best]
            # Close the gap of the right symbol, and of the pair it began.
            shift = columns + (columns > best[:, None])
            narrowed = np.full_like(symbols, EMPTY)
            narrowed[:, :-1] = np.take_along_axis(symbols, shift, axis=1)
            symbols = narrowed
            symbols[at, best] = merged
            shift = np.minimum(shift, width - 1)
            ranks, pieces = np.take_along_axis(ranks, shift, axis=1), np.take_along_axis(pieces, shift, axis=1)
            ranks[:, -1] = NEVER
            ranks[at, best], pieces[at, best] = self._lookup(merged, symbols[at, best + 1])
            led = best > 0
            before = best[led] - 1
            ranks[at[led], before], pieces[at[led], before] = self._lookup(symbols[at[led], before], merged[led])

    def merge_long(self, part: str) -> list[int]:
        """The agenda of one long part as a heap of (rank, place)."""
        symbols = self.symbol_of[np.frombuffer(part.encode("utf-32-le"), np.uint32)].tolist()
        count, merges = len(symbols), self.merges
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        agenda: list[tuple[int, int, int]] = []

        def propose(left: int, right: int) -> None:
            found = merges.get(symbols[left] << 32 | symbols[right])
            if found:
                heapq.heappush(agenda, (found[0], left, found[1]))

        for place in range(count - 1):
            propose(place, place + 1)
        while agenda:
            rank, place, piece = heapq.heappop(agenda)
            other = after[place]
            # An entry is stale once one of its symbols has been merged with another.
            if symbols[place] == EMPTY or other >= count or merges.get(symbols[place] << 32 | symbols[other]) != (rank, piece):
                continue
            symbols[place], symbols[other] = piece, EMPTY
            after[place] = following = after[other]
            if following < count:
                before[following] = place
                propose(place, following)
            if before[place] >= 0:
                propose(before[place], place)
        return self._as_ids(symbols)

    def _as_ids(self, symbols: list[int]) -> list[int]:
        """Piece ids; a character without a piece becomes its bytes."""
        if max(symbols) < self.size:
            return [symbol for symbol in symbols if symbol != EMPTY]
        ids = []
        for symbol in symbols:
            if symbol >= self.size:
                ids += [self.bytes[b] for b in chr(symbol - self.size).encode()]
            elif symbol != EMPTY:
                ids.append(symbol)
        return ids

    def cut(self, text: str) -> list[str]:
        """A text with word marks for spaces, and one in front, cut where no merge passes."""
        return self.parted(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, batch: list[str]) -> list[list[str]]:
        """Encode the new parts of a batch of texts and check them against the library; gives each text's parts."""
        found: set[str] = set()
        cuts = [self.cut(text) for text in batch]
        for parts in cuts:
            found.update(parts)
        if len(self.parts) + len(found) > KEPT_PARTS:
            self.parts = {part: self.parts[part] for part in found if part in self.parts}
        unknown = [part for part in found if part not in self.parts]
        for first in range(0, len(unknown), TOGETHER):
            self._encode_parts(unknown[first:first + TOGETHER])
        return cuts

    def _encode_parts(self, parts: list[str]) -> None:
        ids: dict[str, list[int]] = {}
        short = sorted((part for part in parts if len(part) <= SHORT), key=len)
        for first in range(0, len(short), ROWS):
            some = short[first:first + ROWS]
            ids.update(zip(some, self.merge_short(some), strict=True))
        ids.update((part, self.merge_long(part)) for part in parts if len(part) > SHORT)
        for lead in (True, False):
            some = [part for part in parts if (part[0] == MARK) == lead]
            # The library puts a word mark in front: take the part's own off, or keep both apart.
            given = [part[1:].replace(MARK, " ") if lead else self.stop + part for part in some]
            prefix = [] if lead else self.library.encode(self.stop)
            for part, theirs in zip(some, self.library.encode(given, num_threads=1), strict=True):
                if part != MARK and theirs != prefix + ids[part]:
                    raise ValueError(f"the library encodes {part!r} differently: {theirs}")
        self.parts.update((part, array("i", found).tobytes()) for part, found in ids.items())

    def encode(self, text: str) -> np.ndarray:
        """Ids with the end id; its parts must have been learned."""
        return self.joined(self.cut(text))

    def joined(self, parts: list[str]) -> np.ndarray:
        """Ids of learned parts in a row, with the end id."""
        return np.frombuffer(b"".join([*map(self.parts.__getitem__, parts), self.end]), np.int32)

    def encode_all(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of every text, cut once each, some texts at a time."""
        ids: list[np.ndarray] = []
        some: list[str] = []
        size = 0
        for text in batch:
            if some and size + len(text) > CUT_CHARS:
                ids += map(self.joined, self.learn(some))
                some, size = [], 0
            some.append(text)
            size += len(text)
        return ids + [*map(self.joined, self.learn(some))]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the space that stands for the first word mark is taken off."""
        return b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")

    def check(self, text: str, ids: np.ndarray) -> None:
        """Compare one whole text's ids with the library."""
        theirs = self.library.encode(text, add_eos=True)
        if ids.tolist() != theirs or self.decode(ids) != self.library.decode(theirs):
            raise ValueError("the library encodes or decodes a text of this batch differently")


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """Rows (doc_id, ids, decoded): the ids of every text, end id included, and their decoded text."""
    def start():
        codec = kept_in_process(("sentencepiece", model), lambda: MergeCodec(model))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            whole = [text or "" for text in texts(batch)]
            ids = codec.encode_all(whole)
            codec.check(whole[0], ids[0])
            decoded = list(map(codec.decode, ids))
            ends = np.cumsum([0] + [len(found) for found in ids]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
                 pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )
        return step

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return over_batches(columns, "doc_id long, ids array<int>, decoded string", start)

"""SentencePiece BPE encoding and decoding from a merge-type prefix table.

BPE's result has the property that every prefix of a text has one last token: the token that ends
there and is compatible with the last token of the prefix before it. Two tokens are compatible if
encoding their joined text gives these two again; that is decided by undoing the later of their
merges step by step and asking whether a merge across the border would have come first. So one
pass over an automaton's matches fills a table with each prefix's last token, and the ids are read
off it backwards. The work is linear in the text, whatever its length, and nothing is merged.

Pieces never cross a line break, nor go on after a blank that follows something else, so a text is
a row of segments (a blank and what follows it), encoded once per process and looked up after that.
Runs of blanks are the one place where merges have equal scores; there the leftmost comes first,
which amounts to taking the longest piece that the run still allows (see ``_blanks``).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kept
from .shipping import ship
from .text import coded, gathered, slices

BLANK = "▁"
_SEGMENT = re.compile(" *[^ \n]+| +|\n")
_BASE = -1  # rank of single characters: there from the start
KEPT_SEGMENTS = 800_000  # segments remembered by a process; the memory is cleared when it is full
KEPT_LENGTH = 48  # longer segments are encoded each time


class PieceCodec:
    """Encodes and decodes as the sentencepiece library does, without begin and end ids."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.unknown = model.unk_id()
        normal = [
            i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.normal = frozenset(normal)
        self.id_of = {self.pieces[i]: i for i in normal}
        self.characters = frozenset(p for p in self.id_of if len(p) == 1)
        merged = [i for i in normal if len(self.pieces[i]) > 1 and self.pieces[i].strip(BLANK)]
        if any(BLANK in self.pieces[i][1:] for i in merged):
            raise ValueError("a piece goes on after a blank: segments would not be independent")
        if any("\n" in p for p in self.id_of):
            raise ValueError("a piece holds a line break: segments would not be independent")
        merged.sort(key=lambda i: -model.get_score(i))
        scores = [model.get_score(i) for i in merged]
        if len(set(scores)) < len(scores):
            raise ValueError("two merges have one score: their order would depend on places")
        self.blank_runs = {len(p): i for p, i in self.id_of.items() if not p.strip(BLANK)}
        self.rank = {i: _BASE for i in normal if len(self.pieces[i]) == 1} | {i: r for r, i in enumerate(merged)}
        self.split: dict[int, tuple[int, int]] = {}
        self._find_splits(merged)
        self.automaton = ahocorasick.Automaton()
        for i in normal:
            if self.rank.get(i) == _BASE or i in self.split:
                self.automaton.add_word(self.pieces[i], (i, len(self.pieces[i])))
        self.automaton.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}
        self._segments: dict[str, tuple[bytes, str]] = {}

    def _find_splits(self, merged: list[int]) -> None:
        """The two tokens of each token's last merge; tokens that merging never makes have none."""
        for token in merged:
            parts = [self.id_of.get(c) for c in self.pieces[token]]
            if None in parts:
                continue
            last = None
            while len(parts) > 1:
                ranked = [
                    (self.rank[c], k)
                    for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                    if (c := self._joined(a, b)) is not None
                ]
                if not ranked:
                    break
                _, k = min(ranked)
                last = (parts[k], parts[k + 1])
                parts[k : k + 2] = [self._joined(*last)]
            if parts == [token]:
                self.split[token] = last

    def _joined(self, a: int, b: int) -> int | None:
        joined = self.id_of.get(self.pieces[a] + self.pieces[b])
        return joined if joined in self.rank else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding the text of ``a`` and ``b`` together gives ``a`` and ``b``."""
        known = self._compatible.get((a, b))
        if known is None:
            if len(self._compatible) > 2_000_000:
                self._compatible.clear()
            known = self._compatible[a, b] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        before = float("inf")  # a merge over the border wins if it comes before this time
        while True:
            joined = self._joined(a, b)
            if joined is not None and 2 * self.rank[joined] < before:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra == rb == _BASE:
                return True
            if ra > rb:  # of equal merges the left comes first, so on a tie the right one is undone
                before, a = 2 * ra, self.split[a][1]
            else:
                before, b = 2 * rb + 1, self.split[b][0]

    def _word(self, word: str) -> list[int]:
        """Ids of a segment with at most one blank, at its start, whose characters are all pieces."""
        last = [0] * (len(word) + 1)
        filled = 0
        known = self._compatible
        for end, (token, length) in self.automaton.iter(word):
            if filled <= end:
                start = end + 1 - length
                if start == 0:
                    fits = True
                else:
                    fits = known.get((last[start], token))
                    if fits is None:
                        fits = self.compatible(last[start], token)
                if fits:
                    filled = end + 1
                    last[filled] = token
        ids = []
        at = len(word)
        while at:
            ids.append(last[at])
            at -= len(self.pieces[last[at]])
        ids.reverse()
        return ids

    def _blanks(self, n: int) -> list[int]:
        """Ids of a run of blanks: all merges tie, so the leftmost piece grows as far as it can."""
        runs, out, grown = self.blank_runs, [], []
        for _ in range(n):
            grown.append(1)
            while len(grown) > 1 and grown[-2] + grown[-1] in runs:
                grown[-2:] = [grown[-2] + grown[-1]]
            if len(grown) > 2:  # what cannot grow any more is final
                out.append(grown.pop(0))
        return [runs[k] for k in out + grown]

    def _segment(self, segment: str) -> list[int]:
        word = segment.lstrip(BLANK)
        blanks = len(segment) - len(word)
        if not word:
            return self._blanks(blanks)
        if blanks:
            word, blanks = BLANK + word, blanks - 1
        ids: list[int] = []
        start = 0
        if not self.characters.issuperset(word):
            for k, c in enumerate(word):
                if c not in self.characters:
                    ids += self._word(word[start:k])
                    ids += [self.byte_ids[b] for b in c.encode("utf-8")]
                    start = k + 1
        ids += self._word(word[start:])
        if blanks and ids[0] == self.blank_runs.get(1):  # the last blank stayed alone and joins its run
            return self._blanks(blanks + 1) + ids[1:]
        return self._blanks(blanks) + ids

    def looked_up(self, segment: str) -> tuple[bytes, str]:
        """Ids of a segment (blanks as ' ') as little-endian int32, and what they decode to in a text."""
        found = self._segments.get(segment)
        if found is None:
            if "\n" in segment and len(segment) > 1:
                parts = [self.looked_up(x) for x in _SEGMENT.findall(segment)]
                return b"".join([x[0] for x in parts]), "".join([x[1] for x in parts])
            ids = self._segment(segment.replace(" ", BLANK))
            surface = self._surface(ids)
            found = (array("i", ids).tobytes(), segment if surface == segment else surface)
            if len(segment) <= KEPT_LENGTH:
                if len(self._segments) >= KEPT_SEGMENTS:
                    self._segments.clear()
                self._segments[segment] = found
        return found

    def encode_and_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian int32, and the text they decode to.

        A segment's ids stand for whole characters, so decoding the segments one by one and
        joining them is decoding the whole.
        """
        if not text:
            return b"", ""
        found = [self.looked_up(s) for s in _SEGMENT.findall(" " + text.replace(BLANK, " "))]
        return b"".join([x[0] for x in found]), "".join([x[1] for x in found])[1:]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_and_decode(text)[0], dtype="<i4").tolist()

    def _surface(self, ids: list[int]) -> str:
        if self.normal.issuperset(ids):
            return "".join([self.pieces[i] for i in ids]).replace(BLANK, " ")
        out = bytearray()
        for i in ids:
            byte = self.bytes_of.get(i)
            if byte is not None:
                out.append(byte)
            elif i in self.normal:
                out += self.pieces[i].replace(BLANK, " ").encode("utf-8")
            elif i == self.unknown:
                out += " ⁇ ".encode()
        return out.decode("utf-8", errors="replace")

    def decode(self, ids: list[int]) -> str:
        """The text; the blank put before every text goes again. Control ids say nothing."""
        text = self._surface(ids)
        first = next((i for i in ids if i in self.normal or i in self.bytes_of or i == self.unknown), None)
        return text[1:] if first in self.normal and text[:1] == " " else text


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


kept.remember("piece_codec", codec.cache_clear)


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (array of int, all of the text), decoded (the text they give).

    Null and empty texts have no ids and decode to the empty text. Repeated rows each give a row.
    Columns of other names are ignored, an empty table gives no rows. ``model_path`` must be
    readable on every executor. A process keeps at most ``KEPT_SEGMENTS`` segments.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("piece_codec")
        own = codec(model_path)
        for batch in table:
            for part in slices(batch, "text"):
                ids, decoded = _encode_rows(own, pc.fill_null(part.column("text"), ""))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, decoded], names=["id", "ids", "decoded"])

    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def _encode_rows(own: PieceCodec, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Ids and decoded texts of many rows; each distinct segment of theirs is looked up once.

    Rows whose blanks all stand alone inside the text are split at them; the others go one by one.
    """
    odd = pc.or_(pc.match_substring_regex(texts, "^ | $|  |" + BLANK), pc.equal(texts, ""))
    offsets, codes, words = coded(pc.split_pattern(texts.filter(pc.invert(odd)), " "))
    found = [own.looked_up(" " + w) for w in words.to_pylist()]
    ids, ends = gathered(codes, [x[0] for x in found], "<i4")
    surfaces = pa.array([x[1][1:] for x in found], pa.string()).take(pa.array(codes))
    plain = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), surfaces), " ")
    if not pc.any(odd).as_py():
        return _lists(ends[offsets], ids), plain
    starts = ends[offsets]
    rows, all_texts = [], []
    at = 0
    for alone, text in zip(odd.to_pylist(), texts.to_pylist(), strict=True):
        if alone:
            encoded, decoded = own.encode_and_decode(text)
            rows.append(np.frombuffer(encoded, dtype="<i4"))
            all_texts.append(decoded)
        else:
            rows.append(ids[starts[at] : starts[at + 1]])
            all_texts.append(plain[at].as_py())
            at += 1
    return _lists(np.cumsum([0, *map(len, rows)]), np.concatenate(rows)), pa.array(all_texts, pa.string())


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

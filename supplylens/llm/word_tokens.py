"""Token ids of whole texts by a ``tokenizers`` file, each distinct word encoded once per process.

Holds for tokenizers that drop white space and never join what it sets apart, as word-end BPE does:
a text's ids are then the ids of its white-space separated words in a row. Nothing else is assumed;
the library encodes every word.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kept
from .shipping import ship
from .text import coded, gathered, slices

#: Fixed value: the pattern of the word-end BPE files, and what it comes to on lower-case printable ASCII.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_LATIN_SPLIT = regex.compile(_SPLIT)
#: Printable ASCII and the Latin letters from U+00C0 on: no white space, nothing that composes, and each
#: lower-cased on its own, so Python's lower case and the pattern's own classes are the library's.
_LATIN = re.compile("[!-~\u00c0-\u024f]+")
#: Words and parts of words remembered by a process; a memory that is full is cleared.
KEPT_WORDS, KEPT_PARTS = 200_000, 400_000
KEPT_LENGTH = 48
#: Bytes of text encoded at once; the words and ids of a text take some ten times as much.
_SLICE_BYTES = 1_000_000


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself if it is a visible Latin-1 one, else the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class WordTokens:
    """The file's normaliser, splitter and merges, called for each distinct word and part of a word.

    A word of printable ASCII and Latin letters is split here, by the file's own pattern; the
    library's normaliser and splitter see the others, and its merges all of them. A word that may
    hold a special token goes through the library whole.
    """

    _letters = _byte_letters()

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._normal = self.tokenizer.normalizer.normalize_str
        self._split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self._merge = self.tokenizer.model.tokenize
        pattern = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if pattern != _SPLIT or not self._normal("A") == "a":
            raise ValueError("the tokenizer splits words by another pattern than this class knows")
        self._known: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        kept.give_back()  # what reading the file took

    def _part(self, part: str) -> bytes:
        found = self._parts.get(part)
        if found is None:
            found = array("I", [t.id for t in self._merge(part)]).tobytes()
            if len(part) <= KEPT_LENGTH:
                if len(self._parts) >= KEPT_PARTS:
                    self._parts.clear()
                self._parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        if "<|" in word:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if word.isascii() and word.isprintable():
            return b"".join([self._part(p) for p in _ASCII_SPLIT.findall(word.lower())])
        if _LATIN.fullmatch(word):
            letters = self._letters
            parts = _LATIN_SPLIT.findall(word.lower())
            return b"".join([self._part(p if p.isascii() else p.encode().decode("latin-1").translate(letters)) for p in parts])
        return b"".join([self._part(p) for p, _ in self._split(self._normal(word))])

    def look_up(self, words: list[str]) -> list[bytes]:
        """Each word's ids as little-endian uint32."""
        known, parts = self._known, self._parts
        if len(known) >= KEPT_WORDS:
            known.clear()
        found = [known.get(w) for w in words]
        for k, x in enumerate(found):
            if x is None:
                word = words[k]
                # an ASCII part is a word of that one part; other parts are written in byte letters
                x = parts.get(word) if word.isascii() else None
                if x is None:
                    x = self._word(word)
                    if len(word) <= KEPT_LENGTH and not (word in parts and word.isascii()):
                        known[word] = x
                found[k] = x
        return found

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows as one array, and the rows' offsets in it; null is empty."""
        offsets, codes, words = coded(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
        ids, ends = gathered(codes, self.look_up(words.to_pylist()))
        return ids, ends[offsets]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


kept.remember("word_tokens", word_tokens.cache_clear)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, most: int, end_id: int | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian uint32 as binary).

    A document is its ids and ``end_id``; only one of more than ``most`` tokens is cut.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("word_tokens")
        own = word_tokens(tokenizer_path)
        end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        for batch in table:
            for part in slices(batch, "text", _SLICE_BYTES):
                ids, offsets = own.encode_rows(part.column("text"))
                row, piece, blobs = [], [], []
                for r in range(part.num_rows):
                    blob = ids[offsets[r] : offsets[r + 1]].tobytes() + end
                    for k in range(0, max(1, len(blob)), 4 * most):
                        row.append(r)
                        piece.append(k // (4 * most))
                        blobs.append(blob[k : k + 4 * most])
                number = np.array(piece, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(row, pa.int32())), pa.array(number),
                        pa.array(number.astype(np.int64) * most), pa.array([len(b) // 4 for b in blobs], pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["id", "piece", "start", "length", "ids"],
                )
        kept.give_back()

    out = rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("id", id_col)

"""Rows that every operator must bear, and the plain rules that the brute-force versions use."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, n long, key string, gram string, block string, score string, kept string, word string, count string"
)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if k % 9 == 8 else ''}" for k in range(n))


def awkward_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, near copies and shared passages."""
    rng = random.Random(4)
    base, passage, long = prose(rng, 120), prose(rng, 70), prose(rng, 12_000, 3000)
    rows: list[tuple[int | None, str | None]] = [
        (0, None), (1, ""), (2, "   \n\t"), (3, "one"), (4, "One"), (5, "two words"), (6, "a b c"), (7, "A b\nc"),
        (8, base), (9, base.upper()), (10, base + " tail"), (11, base.replace("w1 ", "v1 ", 1)),
        (12, f"{prose(rng, 30)} {passage} {prose(rng, 25)}"), (13, f"{prose(rng, 5)}\n{passage}\n{prose(rng, 40)}"),
        (14, passage), (15, long), (16, long + " end"), (17, "é ü ñ 漢字 😀 İstanbul"), (18, "#$% &* 123 456"),
        (19, " ".join(["same line here"] * 60)), (20, "x" * 9000), (None, "no id here"), (None, None), (None, base),
        (8, base), (8, base), (21, "MIT License"), (22, "SPDX-License-Identifier: MIT OR GPL-2.0-only\ncode"),
    ]
    rows += [(30 + k, base + " " + prose(rng, 1)) for k in range(12)]  # a group of near copies
    rows += [(60 + k, prose(rng, rng.randint(40, 90))) for k in range(40)]
    rows += [(200 + k, "copy of one text") for k in range(25)]
    return rows


def frame(spark, rows):
    """The rows as documents with further columns, some called as the operators' own."""
    return spark.createDataFrame(
        [(i, t, "en" if k % 3 else "de", f"src{k % 4}" if k % 5 else None, None, 1, 2, "k", "g", "b", "s", "x", "w", "c")
         for k, (i, t) in enumerate(rows)],
        SCHEMA,
    )

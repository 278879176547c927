"""License scans: an automaton for tags and notice phrases, a shunting-yard parser for expressions.

A text is reduced to its words (ASCII letters lower-cased, digits and everything beyond ASCII), one
blank between them. One Aho-Corasick pass finds every phrase wherever its words stand side by side,
so cost is linear in the text and does not depend on how many phrases there are. Where it finds the
words of an identifier tag, the expression is read from the text as it was written, right behind the
tag, turned into postfix order with operators WITH over AND over OR, and evaluated. An expression that
is not complete at the end of a line, or goes on with an operator in the next, is read over the line
break and the marks of a comment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .text import raw_texts, slices, word_bounds

#: What counts as a word character; other bytes set words apart.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Phrases that count as base matches, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of notices, with label and how far one match is believed.
NOTICE_PHRASES = {
    "academic free license": ("afl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "artistic license": ("artistic", 0.7),
    "boost software license": ("bsl", 0.8),
    "bsd 2 clause": ("bsd", 0.8),
    "bsd 3 clause": ("bsd", 0.8),
    "bsd license": ("bsd", 0.6),
    "business source license": ("busl", 0.8),
    "cc0 1 0 universal": ("cc0", 0.9),
    "cecill free software license agreement": ("cecill", 0.9),
    "common development and distribution license": ("cddl", 0.8),
    "common public license": ("cpl", 0.7),
    "creative commons attribution": ("cc", 0.7),
    "creative commons zero": ("cc0", 0.8),
    "do what the fuck you want to public license": ("wtfpl", 0.9),
    "eclipse public license": ("epl", 0.8),
    "educational community license": ("ecl", 0.8),
    "european union public licence": ("eupl", 0.9),
    "free documentation license": ("gfdl", 0.8),
    "historical permission notice and disclaimer": ("hpnd", 0.8),
    "isc license": ("isc", 0.6),
    "latex project public license": ("lppl", 0.9),
    "lesser general public license": ("lgpl", 0.8),
    "library general public license": ("lgpl", 0.8),
    "licensed under the apache license version 2 0": ("apache", 0.9),
    "microsoft public license": ("ms", 0.8),
    "microsoft reciprocal license": ("ms", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "open database license": ("odbl", 0.8),
    "open software license": ("osl", 0.7),
    "openssl license": ("openssl", 0.7),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "permission to use copy modify and or distribute this software for any purpose": ("isc", 0.9),
    "postgresql license": ("postgresql", 0.7),
    "python software foundation license": ("python", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "released under the mit license": ("mit", 0.9),
    "server side public license": ("sspl", 0.8),
    "sil open font license": ("ofl", 0.9),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "this software is provided as is without any express or implied warranty": ("zlib", 0.6),
    "universal permissive license": ("upl", 0.8),
    "zope public license": ("zpl", 0.8),
}
_BASE_BELIEF = 0.6
_TAG = "spdx license identifier"
_TAG_BELIEF, _UNKNOWN_BELIEF = 0.95, 0.5  # of an expression of listed names, and of one with another name

#: Versions of the listed identifiers; a family without any is an identifier itself.
VERSIONS = {
    "0BSD": "", "AFL": "1.1 1.2 2.0 2.1 3.0", "AGPL": "1.0 3.0", "Apache": "1.0 1.1 2.0", "Artistic": "1.0 2.0",
    "Beerware": "", "BlueOak": "1.0.0", "BSD": "1-Clause 2-Clause 3-Clause 4-Clause", "BSL": "1.0", "BUSL": "1.1",
    "CC-BY": "1.0 2.0 2.5 3.0 4.0", "CC-BY-NC": "1.0 2.0 2.5 3.0 4.0", "CC-BY-NC-ND": "1.0 2.0 2.5 3.0 4.0",
    "CC-BY-NC-SA": "1.0 2.0 2.5 3.0 4.0", "CC-BY-ND": "1.0 2.0 2.5 3.0 4.0", "CC-BY-SA": "1.0 2.0 2.5 3.0 4.0",
    "CC0": "1.0", "CDDL": "1.0 1.1", "CECILL": "1.0 1.1 2.0 2.1 B C", "CPL": "1.0", "curl": "", "ECL": "1.0 2.0",
    "EPL": "1.0 2.0", "EUPL": "1.0 1.1 1.2", "FTL": "", "GFDL": "1.1 1.2 1.3", "GPL": "1.0 2.0 3.0", "HPND": "",
    "ICU": "", "IJG": "", "ISC": "", "JSON": "", "LGPL": "2.0 2.1 3.0", "Libpng": "", "LPPL": "1.0 1.1 1.2 1.3a 1.3c",
    "MIT": "", "MIT-0": "", "MIT-CMU": "", "MPL": "1.0 1.1 2.0", "MS": "PL RL", "NCSA": "", "ODbL": "1.0",
    "OFL": "1.0 1.1", "OpenSSL": "", "OSL": "1.0 1.1 2.0 2.1 3.0", "PHP": "3.0 3.01", "PostgreSQL": "", "PSF": "2.0",
    "Python": "2.0 2.0.1", "QPL": "1.0", "RPL": "1.1 1.5", "Ruby": "", "Sleepycat": "", "SSPL": "1.0", "TCL": "",
    "Unicode": "3.0 DFS-2015 DFS-2016", "Unlicense": "", "UPL": "1.0", "Vim": "", "W3C": "", "WTFPL": "", "X11": "",
    "Xnet": "", "Zend": "2.0", "Zlib": "", "ZPL": "1.1 2.0 2.1",
}
_ANY_LATER = ("AGPL", "GFDL", "GPL", "LGPL")  # whose versions may end in these
_LATER = ("", "+", "-only", "-or-later")
#: Exceptions that may stand behind WITH.
EXCEPTIONS = (
    "Autoconf-exception-2.0 Autoconf-exception-3.0 Bison-exception-2.2 Bootloader-exception Classpath-exception-2.0 "
    "CLISP-exception-2.0 eCos-exception-2.0 Font-exception-2.0 freertos-exception-2.0 GCC-exception-2.0 "
    "GCC-exception-3.1 GPL-CC-1.0 i2p-gpl-java-exception Libtool-exception Linux-syscall-note LLVM-exception "
    "LZMA-exception mif-exception OCaml-LGPL-linking-exception OpenJDK-assembly-exception-1.0 "
    "PS-or-PDF-font-exception-20170817 Qt-GPL-exception-1.0 Qt-LGPL-exception-1.1 Swift-exception "
    "u-boot-exception-2.0 Universal-FOSS-exception-1.0 WxWindows-exception-3.1"
).split()

#: First part of an identifier, its label, and whether it permits closed redistribution.
FAMILIES = {
    "0bsd": ("bsd", True), "afl": ("afl", True), "agpl": ("agpl", False), "apache": ("apache", True),
    "artistic": ("artistic", True), "beerware": ("beerware", True), "blueoak": ("blueoak", True), "bsd": ("bsd", True),
    "bsl": ("bsl", True), "busl": ("busl", False), "cc": ("cc", False), "cc0": ("cc0", True), "cddl": ("cddl", False),
    "cecill": ("cecill", False), "cpl": ("cpl", False), "curl": ("curl", True), "ecl": ("ecl", True),
    "epl": ("epl", False), "eupl": ("eupl", False), "ftl": ("ftl", True), "gfdl": ("gfdl", False), "gpl": ("gpl", False),
    "hpnd": ("hpnd", True), "icu": ("icu", True), "ijg": ("ijg", True), "isc": ("isc", True), "json": ("json", True),
    "lgpl": ("lgpl", False), "libpng": ("libpng", True), "lppl": ("lppl", True), "mit": ("mit", True),
    "mpl": ("mpl", False), "ms": ("ms", False), "ncsa": ("ncsa", True), "odbl": ("odbl", False), "ofl": ("ofl", True),
    "openssl": ("openssl", True), "osl": ("osl", False), "php": ("php", True), "postgresql": ("postgresql", True),
    "psf": ("python", True), "python": ("python", True), "qpl": ("qpl", False), "rpl": ("rpl", False),
    "ruby": ("ruby", True), "sleepycat": ("sleepycat", False), "sspl": ("sspl", False), "tcl": ("tcl", True),
    "unicode": ("unicode", True), "unlicense": ("unlicense", True), "upl": ("upl", True), "vim": ("vim", True),
    "w3c": ("w3c", True), "wtfpl": ("wtfpl", True), "x11": ("x11", True), "xnet": ("xnet", True), "zend": ("zend", True),
    "zlib": ("zlib", True), "zpl": ("zpl", True),
}
_BINDS = {"OR": 1, "AND": 2, "WITH": 3}
#: A token behind blanks, or behind line breaks and what begins a line of a comment.
_TOKEN = re.compile(rb"[ \t]*((?:\r?\n[ \t]*(?://+|/?\*+|#+|--+|;+|%+|!+|<!--)?[ \t]*)*)([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_MARK = re.compile(rb"[ \t]*[:=]?")


@cache
def identifiers() -> frozenset[str]:
    """The listed identifiers, lower-cased: every family with its versions."""
    return frozenset(
        f"{family}-{version}{later}".lower() if version else family.lower()
        for family, versions in VERSIONS.items()
        for version in versions.split() or [""]
        for later in (_LATER if family in _ANY_LATER else ("",))
    )


class Verdict(NamedTuple):
    labels: frozenset[str]
    permissive: bool
    known: bool  # every name in it is a listed one
    text: str  # the expression with every choice in brackets


def postfix(text: str | bytes, at: int = 0) -> list[str] | None:
    """Identifiers and operators in postfix order; None if no well-formed expression begins at ``at``.

    It begins in that line and ends where nothing fits: before prose, or at the end of a line where it
    is complete and the next does not begin with an operator in capitals.
    """
    raw = text.encode("utf-8") if isinstance(text, str) else text
    out: list[str] = []
    waiting: list[str] = []
    after_operand = False
    while found := _TOKEN.match(raw, at):
        token = found[2].decode("ascii")
        upper = token.upper()
        if found[1] and (not (out or waiting) or after_operand and "(" not in waiting and token not in _BINDS):
            break
        if upper in _BINDS:
            if not after_operand:
                return None
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[upper]:
                out.append(waiting.pop())
            waiting.append(upper)
            after_operand = False
        elif token == "(":
            if after_operand:
                break
            waiting.append(token)
        elif token == ")":
            if not after_operand or "(" not in waiting:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            if after_operand:  # prose after the expression, such as the end of a comment
                break
            out.append(token)
            after_operand = True
        at = found.end()
    if not after_operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def _license(identifier: str) -> Verdict:
    lower = identifier.lower()
    first = re.split(r"[-+]", lower, maxsplit=1)[0]
    label, permissive = FAMILIES.get(first, (lower.rstrip(".+:-"), False))
    listed = lower in identifiers() or lower.endswith("+") and lower[:-1] in identifiers()
    return Verdict(frozenset([label]), permissive, listed, identifier)


def evaluate(text: str | bytes, at: int = 0) -> Verdict | None:
    """Labels of all licenses named, and whether some choice of the ORs is permissive throughout.

    An exception after WITH belongs to its license and adds no label: it only grants more, but
    does not make a copyleft license permissive. None for an expression that is not well formed.
    """
    order = postfix(text, at)
    if order is None:
        return None
    stack: list[Verdict] = []
    for token in order:
        if token not in _BINDS:
            stack.append(_license(token))
            continue
        right, left = stack.pop(), stack.pop()
        known = left.known and (right.text in EXCEPTIONS if token == "WITH" else right.known)
        if token == "WITH":
            stack.append(Verdict(left.labels, left.permissive, known, f"{left.text} WITH {right.text}"))
        else:
            allowed = (left.permissive and right.permissive) if token == "AND" else (left.permissive or right.permissive)
            stack.append(Verdict(left.labels | right.labels, allowed, known, f"({left.text} {token} {right.text})"))
    return stack[0]


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases: dict[str, list[tuple[str, str, float]]] = {}
    for phrase, label in BASE_PHRASES.items():
        phrases.setdefault(phrase, []).append(("base", label, _BASE_BELIEF))
    for phrase, (label, belief) in NOTICE_PHRASES.items():
        phrases.setdefault(phrase, []).append(("notice", label, belief))
    phrases[_TAG] = [("tag", "", 0.0)]
    for phrase, meanings in phrases.items():
        found.add_word(f" {phrase} ", (phrase.count(" ") + 1, meanings))
    found.make_automaton()
    return found


def scan(raw: bytes) -> dict:
    """n_words, hits (kind, label, first word, words), expressions, labels, permissive, score."""
    spaced = raw.translate(_WORD_BYTES)
    words = spaced.split()
    line = f" {b' '.join(words).decode('utf-8', errors='replace')} "
    hits, labels, doubt, tags = [], set(), 1.0, []
    done = passed = 0  # blanks before position ``done``
    for end, (length, meanings) in _automaton().iter(line):
        passed += line.count(" ", done, end)
        done = end
        for kind, label, belief in meanings:
            if kind == "tag":
                tags.append(passed - 1)  # the tag's last word
                continue
            hits.append({"kind": kind, "label": label, "start": passed - length, "words": length})
            labels.add(label)
            doubt *= 1.0 - belief
    verdicts = []
    if tags:
        ends = word_bounds(spaced)[1]
        for last in tags:
            verdict = evaluate(raw, _MARK.match(raw, int(ends[last])).end())
            if verdict is not None:
                verdicts.append(verdict)
                labels |= verdict.labels
                doubt *= 1.0 - (_TAG_BELIEF if verdict.known else _UNKNOWN_BELIEF)
    return {
        "n_words": len(words), "hits": hits, "expressions": [v.text for v in verdicts], "labels": sorted(labels),
        "permissive": all(v.permissive for v in verdicts) if verdicts else None, "score": 1.0 - doubt,
    }


_HIT = pa.struct([("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("words", pa.int32())])
_FOUND = {
    "n_words": pa.int64(), "hits": pa.list_(_HIT), "expressions": pa.list_(pa.string()),
    "labels": pa.list_(pa.string()), "permissive": pa.bool_(), "score": pa.float64(),
}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, hits, expressions, labels, permissive, score.

    hits holds every match of every phrase, in text order; start counts words from 0. permissive is
    null without an expression. score is 1 minus the product of the matches' doubts, 0 without any.
    Null and empty texts have no words and no hits. Repeated rows each give a row; columns of other
    names are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in table for part in slices(whole, "text")):
            found = [scan(raw) for raw in raw_texts(batch.column("text"))]
            columns = [pa.array([x[n] for x in found], t) for n, t in _FOUND.items()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *_FOUND])

    return rows.mapInArrow(
        run,
        f"id {kind}, n_words long, hits array<struct<kind:string,label:string,start:long,words:int>>, "
        "expressions array<string>, labels array<string>, permissive boolean, score double",
    ).withColumnRenamed("id", id_col)

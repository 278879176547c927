from __future__ import annotations

import random
import re

import pytest
from awkward import LOWER

from supplylens.llm import licenses
from supplylens.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def places(text):
    w = WORD.findall((text or "").translate(LOWER))
    hits = [
        (k, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for k in range(len(w))
        if w[k : k + phrase.count(" ") + 1] == phrase.split()
    ]
    return len(w), sorted(hits)


@pytest.mark.parametrize(
    "text",
    [
        "", None, "MIT License", "mit-license MIT\nLicense mit  license license", "the emit license", "mit licenses",
        "GNU General Public License, Apache License; general public license", "é mit license 漢 apache_license", "mitélicense",
        "mit license " * 500,
    ],
)
def test_base_matches_equal_brute_force(text):
    found = licenses.scan((text or "").encode())
    n, hits = places(text)
    assert found["n_words"] == n
    assert sorted((h["start"], h["label"]) for h in found["hits"] if h["kind"] == "base") == hits
    assert {label for _, label in hits} <= set(found["labels"])
    assert 0 <= found["score"] <= 1


@pytest.mark.parametrize(
    ("expression", "postfix"),
    [
        ("MIT", "MIT"),
        ("MIT OR Apache-2.0 AND ISC", "MIT Apache-2.0 ISC AND OR"),
        ("(MIT OR Apache-2.0) AND ISC", "MIT Apache-2.0 OR ISC AND"),
        ("GPL-2.0-only with Classpath-exception-2.0 or MIT", "GPL-2.0-only Classpath-exception-2.0 WITH MIT OR"),
        ("MIT AND BSD-3-Clause AND ISC", "MIT BSD-3-Clause AND ISC AND"),
        ("MIT */", "MIT"),
        ("MIT and then prose", "MIT then AND"),
    ],
)
def test_postfix(expression, postfix):
    assert " ".join(licenses.postfix(expression)) == postfix


@pytest.mark.parametrize("expression", ["", "OR MIT", "MIT AND", "(MIT", "()", "AND", "WITH x"])
def test_malformed_expressions_are_none(expression):
    assert licenses.evaluate(expression) is None


@pytest.mark.parametrize(
    ("expression", "labels", "permissive"),
    [
        ("MIT OR GPL-3.0-or-later", {"mit", "gpl"}, True),
        ("MIT AND GPL-3.0-or-later", {"mit", "gpl"}, False),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, False),
        ("(Apache-2.0 OR LGPL-2.1+) AND (MIT OR AGPL-3.0-only)", {"apache", "lgpl", "mit", "agpl"}, True),
        ("Foo-1.0", {"foo-1.0"}, False),
    ],
)
def test_expressions_are_evaluated(expression, labels, permissive):
    verdict = licenses.evaluate(expression)
    assert (verdict.labels, verdict.permissive) == (labels, permissive)


@pytest.mark.parametrize(
    ("text", "expressions"),
    [
        ("SPDX-License-Identifier: (MIT OR\n Apache-2.0)", ["(MIT OR Apache-2.0)"]),
        ("// SPDX-License-Identifier: (MIT OR\n// Apache-2.0) AND\r\n//  ISC\n// prose", ["((MIT OR Apache-2.0) AND ISC)"]),
        ("/* SPDX-License-Identifier: GPL-2.0-only\n *  WITH Classpath-exception-2.0\n * OR MIT\n */ text", ["(GPL-2.0-only WITH Classpath-exception-2.0 OR MIT)"]),
        ("# SPDX-License-Identifier: MIT\n# or so they say", ["MIT"]),
        ("SPDX-License-Identifier: MIT\nand more\nspdx license identifier = ISC", ["MIT", "ISC"]),
        ("SPDX-License-Identifier:\nMIT", []),
        ("SPDX-License-Identifier: (MIT OR\n\n", []),
        ("é 漢 SPDX-License-Identifier: MIT <!-- x --> SPDX-License-Identifier: BSD-3-Clause", ["MIT", "BSD-3-Clause"]),
    ],
)
def test_expressions_are_read_behind_their_tag(text, expressions):
    assert licenses.scan(text.encode())["expressions"] == expressions


def test_listed_names_are_believed_more():
    listed = licenses.identifiers()
    assert len(listed) > 150 and {"mit", "gpl-2.0-or-later", "cc-by-nc-sa-4.0", "bsd-3-clause", "ms-pl"} <= listed
    for text, known in (
        ("MIT", True), ("Apache-2.0+ OR GPL-3.0-only WITH GCC-exception-3.1", True), ("MIT OR Own-1.0", False),
        ("GPL-2.0-only WITH Own-exception", False),
    ):
        verdict = licenses.evaluate(text)
        assert verdict.known is known
        score = licenses.scan(f"SPDX-License-Identifier: {text}".encode())["score"]
        assert score == pytest.approx(0.95 if known else 0.5)


def brute_tokens(text, at):
    """Tokens of an expression with whether a line break stands before each, read character by character."""
    fresh, tokens = False, []
    while at < len(text):
        if text[at] in " \t":
            at += 1
        elif text.startswith(("\n", "\r\n"), at):
            at += 1 + (text[at] == "\r")
            fresh = True
            mark = re.match(r"[ \t]*(//+|/?\*+|#+|--+|;+|%+|!+|<!--)", text[at:])
            at += mark.end() if mark else 0
        else:
            token = re.match(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*", text[at:])
            if not token:
                break
            tokens.append((token[0], fresh))
            fresh, at = False, at + token.end()
    return tokens


def brute_expression(tokens):
    """Labels and whether all names are listed, by recursive descent; None if no expression begins here."""
    at = 0

    def more(depth):
        if at >= len(tokens):
            return None
        token, fresh = tokens[at]
        if fresh and depth == 0 and token not in ("AND", "OR", "WITH"):
            return None
        return token.upper() if token.upper() in ("AND", "OR", "WITH") else None

    def operand(depth):
        nonlocal at
        if at >= len(tokens) or tokens[at][0].upper() in ("AND", "OR", "WITH", ")"):
            raise ValueError
        token, at_ = tokens[at][0], at
        if at_ == 0 and tokens[at][1]:
            raise ValueError
        at += 1
        if token != "(":
            return [token]
        inner = chain(depth + 1)
        if at >= len(tokens) or tokens[at][0] != ")":
            raise ValueError
        at += 1
        return inner

    def chain(depth):
        nonlocal at
        names = operand(depth)
        while (operator := more(depth)) is not None:
            at += 1
            right = operand(depth)
            names = names + ([f"WITH {right[0]}"] if operator == "WITH" else right)
        return names

    try:
        return chain(0)
    except ValueError:
        return None


def brute_scan(text):
    """Labels and score by comparing every phrase at every word."""
    text = text or ""
    found = [(m.start(), m.end(), m[0]) for m in WORD.finditer(text.translate(LOWER))]
    w = [x[2] for x in found]
    labels, doubt = set(), 1.0
    phrases = [(p, label, 0.6) for p, label in licenses.BASE_PHRASES.items()]
    phrases += [(p, label, belief) for p, (label, belief) in licenses.NOTICE_PHRASES.items()]
    for phrase, label, belief in phrases:
        for k in range(len(w)):
            if w[k : k + phrase.count(" ") + 1] == phrase.split():
                labels.add(label)
                doubt *= 1 - belief
    for k in range(len(w) - 2):
        if w[k : k + 3] == ["spdx", "license", "identifier"]:
            at = found[k + 2][1]
            at += re.match(r"[ \t]*[:=]?", text[at:]).end()
            names = brute_expression(brute_tokens(text, at))
            if names is None:
                continue
            known = True
            for name in names:
                if name.startswith("WITH "):
                    known &= name[5:] in licenses.EXCEPTIONS
                    continue
                lower = name.lower()
                known &= lower in licenses.identifiers() or lower.removesuffix("+") in licenses.identifiers()
                labels.add(licenses.FAMILIES.get(re.split("[-+]", lower)[0], (lower.rstrip(".+:-"), 0))[0])
            doubt *= 1 - (0.95 if known else 0.5)
    return ",".join(sorted(labels)), 1 - doubt


def test_labels_and_score_equal_brute_force():
    rng = random.Random(6)
    names = ["MIT", "GPL-2.0-only", "Apache-2.0+", "Own-1.0", "BSD-3-Clause", "cc-by-4.0", "0BSD"]
    for _ in range(400):
        parts = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            if kind < 0.3:
                parts.append(rng.choice([*licenses.BASE_PHRASES, *licenses.NOTICE_PHRASES]).title().replace(" ", rng.choice([" ", "-", "\n"])))
            elif kind < 0.8:
                gaps = [" ", "  ", "\n", "\n# ", " \n * ", "\r\n// "]
                words_ = [rng.choice(names)]
                for _ in range(rng.randint(0, 3)):
                    operator = rng.choice(["AND", "OR", "or", "WITH"])
                    words_ += [operator, "Classpath-exception-2.0" if operator == "WITH" and rng.random() < 0.8 else rng.choice(names)]
                if rng.random() < 0.3:
                    words_.insert(0, "(")
                    words_.insert(rng.randint(2, len(words_)), ")")
                parts.append(f"SPDX-License-Identifier{rng.choice([': ', ':', ' = ', ' '])}" + "".join(x + rng.choice(gaps if rng.random() < 0.4 else [" "]) for x in words_))
            else:
                parts.append(rng.choice(["prose, and more", "é 漢", "*/", "MIT", ""]))
        text = rng.choice(["\n", " ", "\n\n"]).join(parts)
        got = licenses.scan(text.encode())
        labels, score = brute_scan(text)
        assert ",".join(got["labels"]) == labels, text
        assert got["score"] == pytest.approx(score), text


def test_rows(awkward, rows, nothing):
    found = licenses.scan_licenses(awkward).collect()
    want = sorted((i is None, i or 0, *places(t)) for i, t in rows)
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, sorted((h.start, h.label) for h in r.hits if h.kind == "base")) for r in found
    )
    assert got == want
    tagged = next(r for r in found if r.doc_id == 22)
    assert (tagged.labels, tagged.permissive, tagged.expressions) == (["gpl", "mit"], True, ["(MIT OR GPL-2.0-only)"])
    assert licenses.scan_licenses(nothing).count() == 0


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op9_license_scans"](spark, small).collect():
        n, hits = places(texts[r.doc_id])
        first, last = (hits[0][0], hits[-1][0]) if hits else (None, None)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(hits), first, last)
        assert r.base_labels == ",".join(sorted({label for _, label in hits}))
        labels, score = brute_scan(texts[r.doc_id])
        assert r.labels == labels and r.score == pytest.approx(score)

from __future__ import annotations

import re

import pytest
from awkward import frame
from pyspark.sql import functions as F

from supplylens.llm import quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(text):
    text = text or ""
    w = WORD.findall(text)
    windows: dict[tuple, list[int]] = {}
    for k in range(len(w) - 2):
        windows.setdefault(tuple(w[k : k + 3]), []).append(k)
    repeated = {k + o for at in windows.values() if len(at) > 1 for k in at for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
        len(w) < 50 or 100 * len(repeated) > 50 * len(w),
    )


def test_measures_equal_brute_force(awkward, rows, nothing):
    found = quality_rules.judge(awkward).collect()
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in found
    )
    assert got == sorted((i is None, i or 0, *expected(t)) for i, t in rows)
    assert not any(r.kept for r in found if r.base_failed)
    assert quality_rules.judge(nothing).count() == 0


@pytest.mark.parametrize("text", ["a b c a b c", "\x0ba b\r\nc\x1ca b c", "a a a a", " \n x\n x\nx", "\x85a\xa0b #|<", "😀 é " * 30])
def test_odd_characters(spark, text):
    r = quality_rules.measures(frame(spark, [(1, text)])).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected(text)[:5]


def test_hosts(spark):
    rows = spark.createDataFrame(
        [("https://user@A.org:80/x?y",), ("src1",), (None,), ("HTTP://b.net",), ("",)], "source string"
    )
    assert [r[0] for r in rows.select(quality_rules.host_of(F.col("source"))).collect()] == ["a.org", "src1", "", "b.net", ""]


def test_a_bad_host_takes_its_good_documents_along_and_a_small_one_does_not(spark):
    good = " ".join(f"word{k}" for k in range(80))
    bad = " ".join(f"word{k} #" for k in range(80))
    rows = [(k, good, "fine") for k in range(300)]
    rows += [(1000 + k, bad if k else good, "spam") for k in range(200)]
    rows += [(2000, bad, "tiny"), (2001, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert all(kept[k] for k in range(300))
    assert not any(kept[1000 + k] for k in range(200))
    assert kept[2000] and kept[2001]  # two documents are too few to judge a host by


def test_shrinkage(spark):
    docs = spark.createDataFrame(
        [(h, 80, 400, 80 if h == "a" and k < 9 else 0, 0, 0, 10) for h, n in (("a", 10), ("b", 500), ("c", 500)) for k in range(n)],
        "host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long",
    )
    rates = {r.host: r for r in quality_rules.host_verdicts(docs).collect()}
    assert 0 < rates["b"].symbols_rate < rates["a"].symbols_rate < 0.9
    assert rates["a"].symbols_failed == 9

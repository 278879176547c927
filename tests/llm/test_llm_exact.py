from __future__ import annotations

import hashlib
from collections import Counter

from awkward import LOWER
from pyspark.sql import functions as F

from supplylens.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def expected(rows):
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        spent = False
        for i in sorted(ids, key=lambda x: -1 if x is None else x):
            kept = i == keep and not spent
            spent |= kept
            out.append((i, keep, len(ids), kept, text))
    return Counter(out)


def test_groups_equal_brute_force(awkward, rows):
    want = Counter({(*k[:4], hashlib.sha256(k[4].encode()).hexdigest()): n for k, n in expected(rows).items()})
    assert Counter(tuple(r) for r in exact_duplicates(awkward).collect()) == want


def test_a_clashing_digest_is_told_apart_by_content(awkward, rows):
    weak = exact_duplicates(awkward, digest=lambda c: F.crc32(F.encode(c, "UTF-8")) % 3).drop("text_digest")
    assert Counter(tuple(r) for r in weak.collect()) == Counter({k[:4]: n for k, n in _summed(rows).items()})


def _summed(rows):
    out: Counter = Counter()
    for k, n in expected(rows).items():
        out[k[:4]] += n
    return out


def test_one_row_of_each_text_stays_with_all_columns(awkward, rows):
    kept = drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    texts = [(r.text or "").translate(LOWER) for r in kept.collect()]
    assert sorted(texts) == sorted({(t or "").translate(LOWER) for _, t in rows})


def test_empty_table(nothing):
    assert exact_duplicates(nothing).count() == 0
    assert drop_exact_duplicates(nothing).count() == 0


def test_a_hot_text_is_merged_before_it_is_shuffled(spark):
    docs = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_duplicates(docs)
    assert found.where("text_digest = sha2('hot', 256)").agg(F.min("group_size"), F.count("*")).first() == (6667, 6667)

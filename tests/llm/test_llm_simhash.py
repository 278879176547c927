from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from awkward import prose, words

from supplylens.llm import simhash
from supplylens.llm.components import connected_components
from supplylens.llm.queries import QUERIES
from supplylens.llm.skew import join_keys


def brute_print(text, size=4):
    w = words(text)
    if not w:
        return 0
    runs = [" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=4):
    """The smallest member of each fingerprint's component, by comparing all with all."""
    left, comp = set(prints), {}
    while left:
        seed = left.pop()
        group, todo = {seed}, [seed]
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= most}
            left -= near
            group |= near
            todo += near
        comp.update({x: frozenset(group) for x in group})
    return comp


def expected(rows, size=4, most=4):
    prints = [brute_print(t, size) for _, t in rows]
    comp = brute_components(prints, most)
    least = defaultdict(lambda: None)
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None and (least[comp[p]] is None or i < least[comp[p]]):
            least[comp[p]] = i
    return Counter((i, f"{p:016x}", least[comp[p]]) for (i, _), p in zip(rows, prints, strict=True))


def test_every_row_equals_brute_force(awkward, rows):
    assert Counter(tuple(r) for r in simhash.near_duplicates(awkward).collect()) == expected(rows)


def test_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert Counter(tuple(r) for r in QUERIES["op13_simhash"](spark, small).collect()) == expected(docs)


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(nothing).count() == 0


def test_long_text_in_chunks(monkeypatch):
    text = prose(random.Random(1), 5000)
    monkeypatch.setattr(simhash, "_CHUNK", 700)
    assert simhash.simhash(text.encode(), 4) == brute_print(text)


def _dense(n: int) -> list[int]:
    """Fingerprints around a few centres, at all distances up to 9, beside far ones."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = {rng.getrandbits(64) for _ in range(n // 4)}
    while len(out) < n:
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 9)):
            x ^= 1 << b
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bucket", [4096, 16])
def test_links_connect_what_is_near(spark, bucket):
    """With small buckets nearly all are split again, round after round, and no pair is lost."""
    prints = _dense(600)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    links = simhash.hamming_links(frame, 4, bucket)
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in pairs)
    found = {r.node % 2**64: r.component % 2**64 for r in connected_components(links, "a", "b").collect()}
    want = brute_components(prints)
    groups = defaultdict(set)
    for p in prints:
        groups[found.get(p, p)].add(p)
    assert {frozenset(g) for g in groups.values()} == set(want.values())


def test_a_dense_bucket_gives_few_links():
    rng = np.random.default_rng(0)
    prints = np.unique(rng.integers(0, 1 << 6, 64).astype(np.uint64))  # at most six bits differ
    a, b = simhash._needed(prints, np.array([len(prints)]), 4)
    assert len(prints) - 1 <= len(a) < 4 * len(prints)


def test_number_of_blocks_follows_the_rows():
    assert [simhash._blocks_for(n, 4) for n in (0, 1000, 1 << 26, 1 << 30, 1 << 36)] == [6, 6, 6, 7, 8]
    for used in (0, 0xFFFF):
        masks = simhash.choices(used, 4, 6)
        assert len(masks) == len(set(masks)) == 15
        assert all(m & used == used for m in masks)


def test_hot_keys_are_joined_whole(spark):
    rows = spark.createDataFrame([(k, 0 if k % 3 == 0 else k) for k in range(3000)], "id long, key long")
    table = rows.select("key").distinct().selectExpr("key", "key * 10 as value")
    counts = rows.groupBy("key").count().withColumnRenamed("count", "n")
    joined = join_keys(rows, table, "key", counts)
    assert {(r.id, r.key, r.value) for r in joined.collect()} == {
        (k, key, key * 10) for k in range(3000) for key in [0 if k % 3 == 0 else k]
    }

from __future__ import annotations

import random

import numpy as np
import pytest
from awkward import frame, prose, words

from supplylens.llm import near_join
from supplylens.llm.components import connected_components


def grams(text, size):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, a):
        self.up.setdefault(a, a)
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def expected(rows, size, num, den):
    sets, joined = [(i, grams(t, size)) for i, t in rows if i is not None], Sets()
    for k, (i, a) in enumerate(sets):
        joined.find(i)
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                joined.join(i, j)
    return sorted((i is None, i or 0, len(grams(t, size)), -1 if i is None else joined.find(i)) for i, t in rows)


def found(docs, size, num, den):
    out = near_join.near_components(docs, size, num, den).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in out)


@pytest.mark.parametrize(("size", "num", "den"), [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_components_equal_brute_force(awkward, rows, size, num, den):
    assert found(awkward, size, num, den) == expected(rows, size, num, den)


def test_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(near_join, "SALT_ROWS", 20)  # hot n-grams are dealt to several tasks
    rng = random.Random(9)
    base = prose(rng, 80).split()
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(30)}"
        rows.append((k, " ".join(w)))
    rows += [(200 + k, prose(rng, rng.randint(1, 12), 6)) for k in range(150)]
    for size, num, den in ((3, 9, 10), (2, 7, 10)):
        assert found(frame(spark, rows).repartition(4), size, num, den) == expected(rows, size, num, den)


def template(n: int, seed: int = 2, length: int = 200, changed: int = 3) -> list[tuple[int, str]]:
    """Texts of one template, each with a few words replaced: nearly all stay under the threshold."""
    rng = random.Random(seed)
    base = [f"t{k}" for k in range(length)]
    rows = []
    for k in range(n):
        words_ = list(base)
        for at in rng.sample(range(length), changed):
            words_[at] = f"own{k}at{at}"
        rows.append((k, " ".join(words_)))
    return rows


def test_texts_of_one_template_are_told_apart_without_their_texts(spark, monkeypatch):
    held = {}
    monkeypatch.setattr(near_join, "PER_BLOCK", 100)  # several blocks an n-gram, short lists and long ones
    monkeypatch.setattr(near_join, "hold", lambda df, label="table", hold=near_join.hold: held.setdefault(label, hold(df, label)))
    rows = template(600) + [(1000 + k, t + " end") for k, t in template(20)]
    assert found(frame(spark, rows).repartition(4), 3, 9, 10) == expected(rows, 3, 9, 10)
    links = held["centre-links"].count() + held["other-links"].count()
    sent = held["alike-centre-pairs"].count() + held["other-pairs"].count()
    assert links >= 20 and sent <= 10 * links + len(rows)


def test_a_sketch_never_differs_in_more_cells_than_the_sets_in_grams():
    rng = np.random.default_rng(4)
    for n in (3, 50, 1000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        for d in (0, 1, 7, n // 2):
            b = np.union1d(a[d:], rng.integers(0, 2**63, d).astype(np.uint64))
            x, y = (np.frombuffer(near_join._sketch(g), dtype=np.uint8) for g in (a, b))
            assert (x != y).sum() <= len(np.setxor1d(a, b)) and (d > 0 or (x == y).all())


def test_one_of_each_group_stays(awkward, rows):
    kept = near_join.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    want = {r[1] for r in expected(rows, 5, 4, 5) if not r[0] and r[1] == r[3]}
    assert {r.doc_id for r in kept.collect()} == want | {None}


def test_empty_table(nothing):
    assert near_join.near_components(nothing, 3, 9, 10).count() == 0


def test_chain_and_star_components(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (300, 200)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(40)} | {200: 200, 300: 200}

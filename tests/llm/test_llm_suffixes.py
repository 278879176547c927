from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest
from awkward import frame, prose, words

from supplylens.llm import suffix_dedup


def coverage(rows, least):
    """For each id the set of word places inside a window that another document has too."""
    holders: dict[tuple, set] = {}
    texts = {i: words(t) for i, t in rows if i is not None}
    for i, w in texts.items():
        for k in range(len(w) - least + 1):
            holders.setdefault(tuple(w[k : k + least]), set()).add(i)
    out = {}
    for i, w in texts.items():
        places = set()
        for k in range(len(w) - least + 1):
            if len(holders[tuple(w[k : k + least])]) > 1:
                places.update(range(k, k + least))
        if places:
            out[i] = places
    return out


def found(docs, least, column="passages"):
    return {
        r.doc_id: {k for p in r[column] for k in range(p.start, p.end)}
        for r in suffix_dedup.repeated_passages(docs, least).collect()
        if r[column]
    }


@pytest.mark.parametrize("least", [50, 20])
def test_passages_equal_brute_force(awkward, rows, least):
    assert found(awkward, least) == coverage(rows, least)


def mixed(seed):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randint(15, 60)) for _ in range(6)]
    rows = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            w = rng.choice(shared).split()
            a = rng.randrange(0, max(1, len(w) - 12))
            parts += [prose(rng, rng.randint(0, 15)), " ".join(w[a : a + rng.randint(10, 60)])]
        rows.append((k, " ".join(parts)))
    return rows


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_cut_and_overlapping_passages(spark, partitions):
    rows = mixed(5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(frame(spark, rows).repartition(4), 20) == coverage(rows, 20)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def keepers(rows, least):
    """(id, start, end, smallest id that any window of the range stands in) of every passage."""
    first: dict[tuple, int] = {}
    holders: dict[tuple, set] = {}
    texts = {i: words(t) for i, t in rows if i is not None}
    for i, w in texts.items():
        for k in range(len(w) - least + 1):
            window = tuple(w[k : k + least])
            holders.setdefault(window, set()).add(i)
            first[window] = min(i, first.get(window, i))
    out = []
    for i, w in texts.items():
        ranges = []
        for k in range(len(w) - least + 1):
            window = tuple(w[k : k + least])
            if len(holders[window]) < 2:
                continue
            if ranges and k <= ranges[-1][1]:
                ranges[-1] = [ranges[-1][0], k + least, min(ranges[-1][2], first[window])]
            else:
                ranges.append([k, k + least, first[window]])
        out += [(i, *r) for r in ranges]
    return sorted(out)


def found_keepers(docs, least):
    found = suffix_dedup.repeated_passages(docs, least).collect()
    return sorted((r.doc_id, p.start, p.end, p.keeper) for r in found for p in r.passages)


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_every_member_of_a_group_names_the_first_document(spark, awkward, rows, partitions):
    rng = random.Random(11)
    long = prose(rng, 300, 5000)
    part = " ".join(long.split()[100:155])
    group = [(2, f"{prose(rng, 30)} {part} {prose(rng, 30)}")] + [(k, long) for k in (5, 7, 9, 11, 12)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        want = keepers(group, 50)
        assert {w[3] for w in want} == {2} and len(want) == 6
        assert found_keepers(frame(spark, group), 50) == want
        assert found_keepers(frame(spark, mixed(5)).repartition(4), 20) == keepers(mixed(5), 20)
        assert found_keepers(awkward, 50) == keepers(rows, 50)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_cutting_leaves_each_passage_once(awkward, rows):
    kept = suffix_dedup.cut_repeats(awkward)
    assert kept.columns == awkward.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    touched = found(awkward, 50, "cuts")
    untouched = sorted((i, t or "") for i, t in rows if i is not None and i not in touched)
    assert sorted((i, t or "") for i, t in left if i is not None and i not in touched) == untouched
    said = {tuple(w[k : k + 50]) for _, t in left for w in [words(t)] for k in range(len(w) - 49)}
    holders: dict[tuple, set] = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 49 if i is not None else 0):
            holders.setdefault(tuple(w[k : k + 50]), set()).add(i)
    assert all(window in said for window, ids in holders.items() if len(ids) > 1)
    assert {w for _, t in rows for w in words(t)} == {w for _, t in left for w in words(t)}
    assert not {i: p for i, p in coverage(dict(left).items(), 50).items()}


def test_cut_text():
    assert suffix_dedup.without("a b  c\nd e", [{"start": 1, "end": 3}]) == "a d e"
    assert suffix_dedup.without(" é b c", [{"start": 0, "end": 1}, {"start": 2, "end": 3}]) == " b "
    assert suffix_dedup.without("a b", [{"start": 0, "end": 2}]) == ""


def test_empty_table(nothing):
    assert suffix_dedup.repeated_passages(nothing).count() == 0
    assert suffix_dedup.cut_repeats(nothing).count() == 0


def test_parts_are_read_as_arrays():
    """200,000 parts of three documents: as Python objects they took some 400 bytes each."""
    parts = [{"lo": k, "hi": k, "keeper": 1, "first": 1} for k in range(100_000)]
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("keeper", pa.int64()), ("first", pa.int64())]))
    lists = pa.array([parts[:7], parts[:50_000], parts, parts[:50_000]], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 3]), lists], names=["doc", "parts"]).slice(1)
    tracemalloc.start()
    found = suffix_dedup._ranges(batch, 50).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole, half = ({"start": 0, "end": n + 49, "keeper": 1} for n in (100_000, 50_000))
    assert [r["passages"] for r in found] == [[half], [whole], [half]]
    assert [r["cuts"] for r in found] == [[], [whole], [half]]
    assert peak < 120 * 200_000

from __future__ import annotations

import random
from collections import defaultdict
from functools import cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from supplylens.llm import packing
from supplylens.llm.vocabularies import vocabulary
from supplylens.llm.word_tokens import WordTokens, word_tokens

WORDS = vocabulary("word_bpe_49k.json")


def fewest(lengths: list[int], capacity: int) -> int:
    @cache
    def best(left: tuple[int, ...], rooms: tuple[int, ...]) -> int:
        if not left:
            return len(rooms)
        options = [best(left[1:], tuple(sorted((*rooms, capacity - left[0]))))]
        for k, r in enumerate(rooms):
            if r >= left[0]:
                options.append(best(left[1:], tuple(sorted((*rooms[:k], r - left[0], *rooms[k + 1 :])))))
        return min(options)

    return best(tuple(sorted(lengths, reverse=True)), ())


@settings(max_examples=150, deadline=None)
@given(st.integers(4, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=7))))
def test_bound_never_exceeds_the_optimum_nor_packing_the_capacity(case):
    capacity, lengths = case
    place, offset, room = packing.best_fit_decreasing(np.array(lengths), capacity)
    optimum = fewest(lengths, capacity)
    assert packing.lower_bound(np.array(lengths), capacity) <= optimum <= len(room)
    for s in range(len(room)):
        inside = sorted((int(offset[k]), lengths[k]) for k in range(len(lengths)) if place[k] == s)
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))]
        assert sum(n for _, n in inside) + room[s] == capacity


def test_exchange_of_many_groups_meets_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 200)
    rng = random.Random(2)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(1, 1000)]) for _ in range(3000)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    placed = packing.pack(pieces, 1000).collect()
    used = defaultdict(list)
    for r in placed:
        used[r.sequence_id].append((r.offset, lengths[r.row]))
    assert sorted(r.row for r in placed) == list(range(3000))
    for inside in used.values():
        inside.sort()
        assert all(o == sum(n for _, n in inside[:k]) for k, (o, _) in enumerate(inside))
        assert sum(n for _, n in inside) <= 1000
    assert len(used) <= packing.lower_bound(np.array(lengths), 1000) + 2


def test_documents(awkward, nothing):
    found = packing.pack_documents(awkward, WORDS, capacity=64).collect()
    own = word_tokens(WORDS)
    want = []
    for r in awkward.collect():
        ids = [*own.tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want += [(r.doc_id, k // 64, k, ids[k : k + 64]) for k in range(0, len(ids), 64)]
    got = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in found]
    order = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    used = defaultdict(list)
    for r in found:
        used[r.sequence_id].append((r.offset, r.length))
    for inside in used.values():
        inside.sort()
        assert all(o == sum(n for _, n in inside[:k]) for k, (o, _) in enumerate(inside))
        assert sum(n for _, n in inside) <= 64
    assert packing.pack_documents(nothing, WORDS).count() == 0


def test_latin_words_are_split_as_the_library_does():
    own = word_tokens(WORDS)
    for c in range(0xC0, 0x250):
        for word in (chr(c), "a" + chr(c), chr(c) + "B", f"é{chr(c)}1.", f"{chr(c)}{chr(c)}'s", f"Q{chr(c)}'ll", f"x{chr(c)}́"):
            want = np.array(own.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
            assert own._word(word) == want, word


def test_a_word_that_is_one_part_is_kept_once():
    own = WordTokens(WORDS)
    words = ["it's", "the", "s", "'s", "é", "Ã©", "Ã", "<|", "The", "the"]
    for _ in range(2):  # the second time from memory
        for w, ids in zip(words, own.look_up(words), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == own.tokenizer.encode(w, add_special_tokens=False).ids
    assert "the" in own._parts and "the" not in own._known and "'s" not in own._known

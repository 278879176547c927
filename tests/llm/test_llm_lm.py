from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from awkward import words
from pyspark.sql import functions as F

from supplylens.llm import lm_score


def expected(rows, learns):
    counts = Counter(w for (i, t), learn in zip(rows, learns, strict=True) if learn for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = [*words(t), None]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i is None, i or 0, len(w), sum(x in counts for x in w), n, round(base, 6)))
    return sorted(out)


def found(scored):
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored
    )


@pytest.mark.parametrize("block_bytes", [24_000_000, 20_000])
def test_base_scores_equal_brute_force(awkward, rows, monkeypatch, block_bytes):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block_bytes)
    learn = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    scored = lm_score.score(awkward.withColumn("train", learn), "train").collect()
    assert found(scored) == expected(rows, [i is not None and i % 3 != 1 for i, _ in rows])
    assert all(r.score <= 0 and math.isfinite(r.score) for r in scored)


def brute_scores(rows, learns):
    """The whole model in loops: counts, classes, the update, and both factors, in double precision."""
    read = [lm_score.tokens((t or "").encode()) for _, t in rows]
    learnt = [x for x, learn in zip(read, learns, strict=True) if learn]
    pairs = np.zeros((lm_score.BUCKETS, lm_score.BUCKETS))
    for _, k in learnt:
        for a, b in zip(k[:-2], k[1:-1], strict=True):
            pairs[a, b] += 1
    class_of = lm_score._class_of(pairs)
    labels = lm_score.CLASSES + 1
    words_ = Counter(int(w) for x, _ in learnt for w in x)
    bucket = {int(w): k for x, ks in read for w, k in zip(x, ks, strict=True)}
    n, v = np.zeros(labels), np.zeros(labels)
    for w, c in words_.items():
        n[class_of[bucket[w]]] += c
        v[class_of[bucket[w]]] += 1
    bias = np.log((n + 1) / (n + 1).sum())
    counts = {}
    for x, k in learnt:
        for place, found in enumerate(lm_score.features(x, k).T):
            for f in found:
                counts.setdefault(int(f), np.zeros(labels))[class_of[k[place]]] += 1
    weights = {f: 0.4 * (np.log((c + 50 * np.exp(bias)) / (c.sum() + 50)) - bias) for f, c in counts.items()}

    def share(found):
        z = bias + sum(weights.get(int(f), 0.0) for f in found)
        e = np.exp(z - z.max())
        return e / e.sum()

    out = []
    for x, k in read:
        score = 0.0
        for place, found in enumerate(lm_score.features(x, k).T):
            c = class_of[k[place]]
            word = (words_[int(x[place])] + 0.5) / (n[c] + 0.5 * (v[c] + 1))
            score += math.log10(share(found)[c]) + math.log10(word)
        out.append(score)
    return out


def test_scores_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"{a}{b}" for a in ("ba", "be", "ko", "xu") for b in ("n", "ro", "sti", "x1")]
    rows = [(k, " ".join(rng.choice(vocabulary, rng.integers(0, 30)))) for k in range(60)] + [(60, None), (61, "new words é 漢")]
    learns = [k % 5 != 1 for k, _ in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.col("doc_id") % 5 != 1)
    found = {r.doc_id: r.score for r in lm_score.score(docs.repartition(3), "train").collect()}
    for (k, _), want in zip(rows, brute_scores(rows, learns), strict=True):
        assert math.isclose(found[k], want, rel_tol=2e-5, abs_tol=2e-4)


def test_scores_do_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("train", F.col("doc_id") % 5 != 1)
    few, many = ({r.doc_id: r.score for r in lm_score.score(docs.repartition(n), "train").collect()} for n in (3, 11))
    assert max(abs(few[k] - many[k]) for k in few) <= 1e-6 * max(abs(x) for x in few.values())


def test_nothing_to_learn_from_and_empty_table(awkward, rows, nothing):
    scored = lm_score.score(awkward.withColumn("train", F.lit(None).cast("boolean")), "train").collect()
    assert found(scored) == expected(rows, [False] * len(rows))
    assert lm_score.score(nothing.withColumn("train", F.lit(True)), "train").count() == 0


def test_class_probabilities_sum_to_one_and_fast_features_equal_a_loop():
    rng = np.random.default_rng(3)
    raw = b"the cat sat on the mat and the cat ran"
    words_, buckets = lm_score.tokens(raw)
    assert len(words_) == 11 and buckets[-1] == lm_score.BUCKETS
    weights = rng.normal(size=(lm_score.FEATURES + 1, 5))
    found = lm_score.features(words_, buckets)
    logits, e, total = lm_score.class_exponentials(lm_score.padded(weights), found)
    slow = np.array([weights[found[:, k]].sum(axis=0) + weights[-1] for k in range(len(words_))])
    assert np.allclose(logits[:, :5], slow, atol=1e-4)
    assert np.allclose(total.astype(float), np.exp(slow).sum(axis=1), rtol=1e-4) and np.allclose(e[:, 5:], 0)
    # the history decides, not the place: equal histories have equal features
    again = lm_score.features(*lm_score.tokens(b"on the mat and the cat ran"))
    assert (lm_score.features(words_, buckets)[:, -3:] == again[:, -3:]).all()


def test_history_helps_on_held_out_text(spark):
    one, other = ["ba", "be", "bi", "bo"], ["xa", "xe", "xi", "xo"]
    rng = np.random.default_rng(5)
    docs = [(k, " ".join(rng.choice(one if k % 2 else other, 40))) for k in range(400)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("train", F.col("doc_id") < 300)
    held = lm_score.score(table, "train").where("doc_id >= 300").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 0.8 * held[0]


def test_further_updates_follow_the_gradient_of_the_model_so_found(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"{a}{b}" for a in ("ba", "be", "ko", "xu") for b in ("n", "ro", "sti", "x1")]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) for _ in range(60)]
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    class_of = np.append(np.arange(lm_score.BUCKETS) % lm_score.CLASSES, lm_score.CLASSES)
    bias = np.log(rng.dirichlet(np.ones(lm_score.CLASSES + 1)))
    first = lm_score._trained(table, class_of, bias, 1)

    counts, shares = np.zeros_like(first), np.zeros_like(first)
    for t in texts:
        x, k = lm_score.tokens(t.encode())
        for place, found in enumerate(lm_score.features(x, k).T):
            z = first[-1] + first[found].sum(axis=0)
            for row in (*found, -1):
                counts[row, class_of[k[place]]] += 1
                shares[row] += np.exp(z) / np.exp(z).sum()
    step = lm_score._RATE * (shares - counts) / (shares * (1 - shares / np.maximum(counts.sum(axis=1, keepdims=True), 1)) + lm_score._LEAST)
    second = lm_score._trained(table, class_of, bias, 2)
    assert np.allclose(second, first - step, atol=1e-4) and not np.allclose(second, first, atol=1e-2)
    other = lm_score._trained(table.repartition(7), class_of, bias, 2)
    assert np.abs(second - other).max() <= 1e-9


def test_the_query_trains_with_every_update(spark, small):
    from supplylens.llm.queries import QUERIES

    docs = spark.read.parquet(f"{small}/documents.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    whole = lm_score.score(docs.withColumn("train", ~held_out), "train", updates=lm_score.UPDATES)
    whole, found = ({r.doc_id: r.score for r in df.collect()} for df in (whole, QUERIES["op7_lm_scoring"](spark, small)))
    assert lm_score.UPDATES >= 2 and found.keys() == whole.keys()
    assert all(math.isclose(found[k], whole[k], rel_tol=1e-6) for k in found)


def test_texts_read_together_are_as_read_one_by_one(awkward, rows, monkeypatch):
    raws = [(t or "").encode() for _, t in rows] + [b"", b" ", b"a", b"", b"b c"]
    one = [lm_score.tokens(raw) for raw in raws]
    words_, buckets, last = lm_score.tokens_together(raws)
    found, begin = lm_score.features(words_, buckets), 0
    for (w, k), end in zip(one, last, strict=True):
        assert (words_[begin : end + 1] == w).all() and (buckets[begin : end + 1] == k).all()
        assert (found[:, begin : end + 1] == lm_score.features(w, k)).all()  # none sees the text before
        assert (buckets[end + 1 : end + 4] == -1).all()
        begin = end + 4
    assert begin == len(words_) and lm_score.tokens(b" ")[1].tolist() == [lm_score.BUCKETS]

    table = awkward.withColumn("train", F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False)))
    scores = []
    for size in (64_000, 100):  # many texts at a time, or about one; and few exponentials at a time
        monkeypatch.setattr(lm_score, "_TOGETHER", size)
        monkeypatch.setattr(lm_score, "_FEW", size)
        scores.append(sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in lm_score.score(table, "train", updates=2).collect()))
    assert len(scores[0]) == len(scores[1]) == len(rows)
    for a, b in zip(*scores, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-5, abs_tol=1e-5)

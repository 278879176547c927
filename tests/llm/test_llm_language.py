from __future__ import annotations

import math
import random
import zlib

import numpy as np
from awkward import SCHEMA, frame

from supplylens.llm import exact_dedup, language, near_join, simhash, suffix_dedup
from supplylens.llm.queries import QUERIES


def test_held_out_accuracy_and_calibration(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = QUERIES["op6_language_id"](spark, small).collect()
    assert sorted(r.doc_id for r in found) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert abs(np.mean([r.score for r in held]) - np.mean([r.lang_pred == truth[r.doc_id] for r in held])) < 0.05


def test_every_row_is_answered(spark, awkward, rows):
    model = language.train(awkward)
    found = model.annotate(awkward)  # has a column called score, which is replaced
    assert found.columns == [*[c for c in awkward.columns if c != "score"], "lang_pred", "score"]
    assert found.schema["score"].dataType.simpleString() == "double" and found.count() == len(rows)
    judged = model.annotate(awkward, names=("guess", "sure")).collect()
    assert len(judged) == len(rows)
    for r in judged:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.guess, r.sure) == ("und", 0.0)
        else:
            assert r.guess in ("de", "en") and 0 <= r.sure <= 1


def test_no_label_and_one_label(spark, awkward, nothing):
    assert {r.lang_pred for r in language.train(nothing).annotate(awkward.select("doc_id", "text")).collect()} == {"und"}
    assert language.train(awkward).annotate(nothing.select("doc_id", "text")).count() == 0
    one = spark.createDataFrame([(1, "bon jour", "fr"), (2, None, "fr"), (3, "x", None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.train(one).annotate(one).where("doc_id = 1").collect()} == {("fr", 1.0)}


def test_counts_against_a_loop():
    text = "Abc abé" * 40
    features, n = language.counts(text)
    assert n.sum() == sum(len(text) - k for k in range(3))
    assert (np.diff(features) > 0).all()
    assert [x.tolist() for x in language.counts("")] == [[], []]


def test_predictions_equal_brute_force(spark, small):
    """Every n-gram in a loop, every weight by itself, from the fitted model's numbers."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.train(docs.where(language.id_remainder("doc_id", 4) != 2))
    factors = [int(x) for x in language._FACTORS]

    def slot(points):
        h = len(points) * 0x27D4EB2F % 2**32
        for p, factor in zip(points, factors, strict=False):
            h = (h ^ p * factor % 2**32) * 0x2C1B3C6D % 2**32
            h ^= h >> 15
        return h >> 17

    def predict(text):
        if text is None or not any(c.isalpha() for c in text):
            return "und", 0.0
        points, tf = [ord(c) for c in text.lower()], {}
        for n in (1, 2, 3):
            for k in range(len(points) - n + 1):
                f = slot(points[k : k + n])
                tf[f] = tf.get(f, 0) + 1
        values = {f: (1 + math.log(n)) * model.idf[f] for f, n in tf.items()}
        norm = math.sqrt(sum(v * v for v in values.values()))
        logits = [
            (float(model.weights[language.DIM][c]) + sum(v / norm * float(model.weights[f][c]) for f, v in values.items())) / model.heat
            for c in range(len(model.labels))
        ]
        p = [math.exp(x - max(logits)) for x in logits]
        best = max(range(len(p)), key=lambda c: p[c])
        return model.labels[best], p[best] / sum(p)

    texts = [r.text for r in docs.limit(60).collect()] + [None, "", "1 2", "İstanbul ǅ é", "a"]
    for text in texts:
        text = text and text[:3000]
        label, sure = predict(text)
        got = model.predict(text)
        assert got[0] == label and abs(got[1] - sure) < 1e-4


def test_a_clash_of_every_private_name(spark):
    """Columns called as the operators' own, in any case, pass through the stages unchanged."""
    names = ["_predicted", "_Probability", "_own_digest", "_group_id", "_gone", "_doc", "_cuts", "_key", "group"]
    rows = [(k, f"some words of text number {k} and more of them here", "en", "s", 9, *["x"] * len(names)) for k in range(12)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([*rows, (99, *rows[3][1:])], schema)
    for stage in (lambda d: language.keep_identified(d, 0.0), exact_dedup.drop_exact_duplicates, near_join.drop_near_duplicates,
                  suffix_dedup.cut_repeats, simhash.drop_near_duplicates):
        kept = stage(docs)
        assert kept.columns == docs.columns
        assert {r[names[0]] for r in kept.collect()} == {"x"} and kept.count() in (12, 13)


def test_follower_separates_and_stays_sparse():
    rng = random.Random(1)
    model, idf = language.Follower(2), np.ones(language.DIM)
    texts = [("aab abb " * rng.randint(1, 5), 0) for _ in range(60)] + [("xyz zyx " * rng.randint(1, 5), 1) for _ in range(60)]
    rng.shuffle(texts)
    for text, label in texts:
        model.learn(*language.vector(text, idf), label)
    w = model.weights()
    for text, label in (("ab ab", 0), ("zy xy", 1)):
        f, v = language.vector(text, idf)
        assert int((v @ w[f] + w[language.DIM]).argmax()) == label
    assert (w == 0).mean() > 0.99


def test_temperature_softens_false_certainty():
    logits = np.array([[8.0, 0.0]] * 10)
    truth = np.array([0] * 7 + [1] * 3)
    hot = language.temperature(logits, truth)
    assert abs(1 / (1 + np.exp(-8 / hot)) - 0.7) < 0.01


def test_rejects_only_the_unreadable(awkward):
    kept = language.keep_identified(awkward, 0.0)
    assert kept.columns == awkward.columns
    want = sorted(str(r) for r in awkward.collect() if r.text and any(c.isalpha() for c in r.text))
    assert sorted(str(r) for r in kept.collect()) == want


def test_schema_of_the_rows_is_kept(spark):
    assert frame(spark, [(1, "a")]).schema.simpleString().startswith("struct<doc_id:bigint,text:string")
    assert SCHEMA.startswith("doc_id long")

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased text's code points, hashed to ``DIM`` columns;
their document counts come from all training rows. Weights are trained by follow-the-regularised-
leader with elastic-net penalties, which leaves most of them exactly 0, on a sample of at most about
``SAMPLE`` labelled rows, dealt evenly to the labels; a fifth of the sample is held back to fit the
temperature that calibrates the probabilities. Everything else covers all rows and whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kept
from .names import unused
from .shipping import ship
from .text import slices

DIM = 1 << 15
SAMPLE = 6000  # bound on the rows a classifier is fitted on, shared evenly by the labels
EPOCHS = 4
_ALPHA, _BETA, _L1, _L2 = 0.5, 1.0, 0.02, 0.001
_FACTORS = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]
UNKNOWN = "und"


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the whole text, in order, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", errors="replace"), dtype="<u4")
    total = np.zeros(DIM, dtype=np.int64)
    for n in (1, 2, 3):
        if len(points) < n:
            break
        h = np.full(len(points) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            h ^= points[k : k + len(h)] * _FACTORS[k]
            h *= np.uint32(0x2C1B3C6D)
            h ^= h >> np.uint32(15)
        total += np.bincount(h >> np.uint32(17), minlength=DIM)
    features = np.flatnonzero(total)
    return features, total[features]


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text's features and their TF-IDF values, of length 1."""
    features, n = counts(text)
    values = (1.0 + np.log(n)) * idf[features]
    norm = np.sqrt(values.dot(values))
    return features, (values / norm if norm else values).astype(np.float32)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Follower:
    """Follow the regularised leader, one coordinate rate per weight; the last row is the bias."""

    def __init__(self, labels: int):
        self.z = np.zeros((DIM + 1, labels))
        self.n = np.zeros((DIM + 1, labels))

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - _L1, 0.0)
        return -shrunk / ((_BETA + np.sqrt(n)) / _ALPHA + _L2)

    def learn(self, features: np.ndarray, values: np.ndarray, label: int) -> None:
        rows, x = np.append(features, DIM), np.append(values, 1.0)
        w = self.weights(rows)
        error = _softmax(x @ w)
        error[label] -= 1.0
        g = x[:, None] * error
        n = self.n[rows]
        self.z[rows] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / _ALPHA * w
        self.n[rows] = n + g * g


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """What to divide logits by for the least log loss, by golden-section search on its logarithm."""

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-300)).mean())

    lo, hi, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _fit(rows: list[tuple[np.ndarray, np.ndarray, int]], labels: int) -> tuple[np.ndarray, float]:
    """Weights (DIM + 1, labels) and temperature; every fifth row is held back for the latter."""
    model = Follower(labels)
    rng = np.random.default_rng(11)
    held = [r for k, r in enumerate(rows) if k % 5 == 4]
    train = [r for k, r in enumerate(rows) if k % 5 != 4] if held else rows
    for _ in range(EPOCHS):
        for k in rng.permutation(len(train)):
            model.learn(*train[k])
    weights = model.weights()
    if not held or labels < 2:
        return weights, 1.0
    logits = np.array([v @ weights[f] + weights[DIM] for f, v, _ in held])
    return weights, temperature(logits, np.array([y for _, _, y in held]))


def _document_counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts have each feature, and how many texts there are: at most DIM + 1 rows reach the driver."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("language")
        total = np.zeros(DIM + 1, dtype=np.int64)
        for batch in (part for whole in table for part in slices(whole, "text")):
            for text in batch.column("text").to_pylist():
                total[counts(text)[0]] += 1
                total[DIM] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["f", "n"])

    found = rows.select("text").mapInArrow(run, "f int, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(DIM + 1, dtype=np.int64)
    total[found["f"].to_numpy()] = found["n"].to_numpy()
    return total[:DIM], int(total[DIM])


class LanguageModel:
    """Labels, IDF, weights and temperature; a few hundred kilobytes whatever the corpus."""

    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.labels, self.idf, self.heat = labels, idf, heat
        self.weights = weights.astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNKNOWN, 0.0
        features, values = vector(text, self.idf)
        p = _softmax((values @ self.weights[features] + self.weights[DIM]).astype(np.float64) / self.heat)
        best = int(p.argmax())
        return self.labels[best], float(p[best])

    def annotate(self, docs: DataFrame, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
        """``docs`` with two more columns, the predicted label and its calibrated probability.

        Null text, and text without a letter, is ``und`` with score 0. Repeated rows each give a
        row; other columns pass through, but those called as ``names`` are replaced; an empty table
        gives no rows.
        """
        ship(docs.sparkSession)
        taken = {n.lower() for n in names}
        if text_col.lower() in taken:
            raise ValueError(f"the new columns {names} would replace the text")
        docs = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in taken])
        at = docs.columns.index(text_col)
        schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

        def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept.only("language")
            for batch in (part for whole in table for part in slices(whole, at)):
                found = [self.predict(t) for t in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns, pa.array([x[0] for x in found], pa.string()),
                        pa.array([x[1] for x in found], pa.float64()),
                    ],
                    names=[*batch.schema.names, *names],
                )

        return docs.mapInArrow(run, schema)


def id_remainder(id_col: str, divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Fit on the rows of ``labelled`` whose text and label are not null.

    All of them count for the IDF. A row is in the sample if a hash of its text falls under
    ``sample / labels / rows of its label``, so each label has about the same number of rows, there
    are about ``sample`` in all, and equal texts are in or out together. No rows give a model that
    answers ``und``; rows of one label give one that always answers this label.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null"
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    labels = sorted(sizes)
    if not labels:
        return LanguageModel([], np.zeros(DIM), np.zeros((DIM + 1, 0)), 1.0)
    documents, total = _document_counts(rows)
    idf = np.log((1.0 + total) / (1.0 + documents)) + 1.0
    share = sample / len(labels)
    # the hash of an equal text is equal: copies would fill the sample, so each text counts once
    chance = F.create_map(*[x for lang in labels for x in (F.lit(lang), F.lit(min(1.0, share / sizes[lang])))])
    drawn = rows.where(
        F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.element_at(chance, F.col("lang")) * float(1 << 30)
    ).dropDuplicates(["text", "lang"])

    def vectors(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for whole in table for part in slices(whole, "text")):
            found = [
                (zlib.crc32(text.encode("utf-8", errors="replace")), lang, *vector(text, idf))
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True)
                if has_letter(text)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string()),
                    pa.array([x[2].astype("<i4").tobytes() for x in found], pa.binary()),
                    pa.array([x[3].astype("<f4").tobytes() for x in found], pa.binary()),
                ],
                names=["place", "lang", "features", "values"],
            )

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(
            row for batch in table for row in zip(*[batch.column(c).to_pylist() for c in batch.schema.names], strict=True)
        )
        where = {lang: k for k, lang in enumerate(labels)}
        rows_ = [(np.frombuffer(f, dtype="<i4"), np.frombuffer(v, dtype="<f4"), where[lang]) for _, lang, f, v in found]
        weights, heat = _fit(rows_, len(labels))
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([heat], pa.float64())], names=["w", "heat"]
        )

    # vectors of at most DIM features each, not texts, come together
    sampled = drawn.mapInArrow(vectors, "place long, lang string, features binary, values binary").repartition(1)
    fitted = sampled.mapInArrow(run, "w binary, heat double").first()
    weights = np.frombuffer(fitted["w"], dtype="<f4").reshape(DIM + 1, len(labels))
    return LanguageModel(labels, idf, weights, fitted["heat"])


def keep_identified(docs: DataFrame, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose language the model names with a probability of at least ``least``, all columns.

    It learns from the labelled rows as the query does. Without any labelled row, no language can be
    named and no row stays.
    """
    model = train(docs.where(id_remainder("doc_id", 4) != 2), text_col)
    predicted, probability = unused(docs.columns, "_predicted", "_probability")
    judged = model.annotate(docs, text_col, (predicted, probability))
    return judged.where((F.col(predicted) != UNKNOWN) & (F.col(probability) >= least)).select(docs.columns)

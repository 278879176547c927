"""LM scoring by a hashed maximum-entropy model with class-factored softmax.

log P(word | history) = log P(class | history) + log P(word | class).

* Words fall into ``BUCKETS`` by their first two and last two bytes. Buckets that keep the same
  company are one of ``CLASSES`` classes: their neighbour counts, gathered over all training text,
  are reduced to a few dimensions and clustered. Any word has a class, known or not; the end of a
  text is a class of its own.
* The class factor is a softmax over hashed features of the words before: bigram, trigram, skipped
  word, and the same over buckets, which also speak for rare words. Its weights are trained by
  distributed gradient updates over all training documents. Without weights the gradient is what
  the counts of a feature's classes lack of the shares of all classes, and the first update takes
  a part of the log ratio that this stands for, smoothed. Each further one is a step along the
  gradient of the model so found, each weight by its curvature. Tasks add up whole numbers, so the
  weights do not depend on how the documents are dealt to tasks.
* The word factor is the same model with the class as its only feature. Its best weights are known
  without training: the word's share of its class, smoothed by half a count, with one such half for
  all unknown words. So the probabilities of the words known and of one unknown sum to 1.

Counts grow with the corpus and are never broadcast: documents are dealt into blocks of bounded
size, each block's distinct words meet their corpus counts in a join on the word, and a block is
scored with its own part of the counts. What is broadcast, weights and class map, has a fixed size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.workspace import hold
from . import kept
from .shipping import ship
from .text import LOWER, hashes_at, mix, raw_texts, slices, word_bounds

BUCKETS = 1024
CLASSES = 24
LANES = 32  # at least CLASSES and the end
FEATURES = 1 << 16
BLOCK_BYTES = 24_000_000
END = np.uint64(0x5E1D5E1D5E1D5E1D)
_STEP = 131_072  # tokens of one gradient step
_FEW = 8192  # tokens whose exponentials are taken at a time: they stay in the processor's cache
_TOGETHER = 64_000  # bytes of short texts that are read at a time
_GAP = 3  # places between texts that are read together: as far back as a feature looks
_ODD = np.random.default_rng(71).integers(1, 2**63, size=8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The first update: part of the log ratio, and counts that stand for no evidence; later ones: step, and least curvature.
_SHARE, _PRIOR, _RATE, _LEAST = 0.4, 50.0, 0.5, 10.0
_UNIT = 1 << 24  # probabilities are added up in whole parts of this
UPDATES = 2  # gradient updates that the query takes
_PART = 1024  # rows of a weight or count table that travel as one value
_MATRIX = "part int, sums binary"


def tokens_together(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints and buckets of the texts' words and ends, and the place of each end.

    The end's bucket is ``BUCKETS``. ``_GAP`` empty places follow each text (fingerprint 0, bucket -1),
    so that no feature of a text sees the one before.
    """
    raw = b" ".join(raws).translate(LOWER)
    starts, ends = word_bounds(raw)
    sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
    before = np.searchsorted(starts, np.cumsum(sizes + 1))  # words up to each text's end
    shift = np.arange(len(raws)) * (1 + _GAP)
    last = before + shift
    words = np.zeros(len(starts) + len(raws) * (1 + _GAP), dtype=np.uint64)
    buckets = np.full(len(words), -1, dtype=np.int64)
    words[last], buckets[last] = END, BUCKETS
    if len(starts):
        b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64)
        shape = b[starts] | b[np.minimum(starts + 1, ends - 1)] << np.uint64(8)
        shape |= b[np.maximum(ends - 2, starts)] << np.uint64(16) | b[ends - 1] << np.uint64(24)
        at = np.arange(len(starts)) + np.repeat(shift, np.diff(before, prepend=0))
        words[at] = hashes_at(raw, starts, ends)
        buckets[at] = mix(shape + np.uint64(1)) % np.uint64(BUCKETS)
    return words, buckets, last


def tokens(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and buckets of the text's words and its end; the end's bucket is ``BUCKETS``."""
    words, buckets, _ = tokens_together([raw])
    return words[:-_GAP], buckets[:-_GAP]


def _together(raws: list[bytes]) -> Iterator[slice]:
    """Texts in a row of about ``_TOGETHER`` bytes, or a single longer one."""
    begin, size = 0, 0
    for k, raw in enumerate(raws):
        if size and size + len(raw) > _TOGETHER:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(raw) + 1
    if begin < len(raws):
        yield slice(begin, len(raws))


def _earlier(x: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places before each; 0 before the beginning."""
    out = np.zeros_like(x)
    out[by:] = x[:-by] if by < len(x) else x[:0]
    return out


def features(words: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Hashed features of each token's history, one row per kind of feature."""
    a = _ODD
    b = buckets.astype(np.uint64) + np.uint64(1)
    w1, w2, b1, b2, b3 = _earlier(words, 1), _earlier(words, 2), _earlier(b, 1), _earlier(b, 2), _earlier(b, 3)
    # fingerprints are mixed already, so the top bits of a product are a hash of them
    kinds = (w1 * a[0], w1 * a[1] + w2 * a[2], w2 * a[3], b1 * a[4], b1 * a[5] + b2 * a[6] + b3 * a[7])
    return np.stack([(k >> np.uint64(48)).astype(np.int32) for k in kinds])


def padded(weights: np.ndarray) -> np.ndarray:
    """Weights as float32 in rows of ``LANES``, whole cache lines; the spare classes never win."""
    out = np.zeros((len(weights), LANES), dtype=np.float32)
    out[:, : weights.shape[1]] = weights
    out[FEATURES, weights.shape[1] :] = -1e4
    return out


def class_exponentials(weights: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of each token's classes, their exponentials, and the sum of these.

    ``weights`` are ``padded``; their last row is the bias. Scores are held under what float32 can
    take the exponential of.
    """
    logits = np.take(weights, found[0], axis=0)
    logits += weights[FEATURES]
    for f in found[1:]:
        logits += np.take(weights, f, axis=0)
    np.minimum(logits, np.float32(80), out=logits)
    e = np.exp(logits)
    return logits, e, e @ np.ones(LANES, dtype=np.float32)


def _class_of(pairs: np.ndarray) -> np.ndarray:
    """Class of each bucket, from how often buckets follow each other (BUCKETS x BUCKETS)."""
    shown = pairs.sum(axis=1) + pairs.sum(axis=0)
    both = np.hstack([pairs, pairs.T]).astype(np.float64)
    share = both / np.maximum(both.sum(axis=1, keepdims=True), 1)
    usual = both.sum(axis=0) / max(both.sum(), 1)
    points = np.sqrt(share) - np.sqrt(usual)  # distances between such rows are Hellinger distances
    weight = np.sqrt(shown + 1.0)
    u, s, _ = np.linalg.svd(points * weight[:, None], full_matrices=False)
    points = (u * s)[:, :24] / weight[:, None]
    centres = points[[int(shown.argmax())]]
    while len(centres) < CLASSES:  # each next centre is what the others explain least
        far = ((points[:, None] - centres) ** 2).sum(axis=2).min(axis=1) * weight
        centres = np.vstack([centres, points[[int(far.argmax())]]])
    for _ in range(25):
        near = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        total = np.bincount(near, weights=weight, minlength=CLASSES)
        sums = np.stack([np.bincount(near, weights=weight * x, minlength=CLASSES) for x in points.T], axis=1)
        centres = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-12)[:, None], centres)
    return np.append(near, CLASSES)


def _summed(parts: DataFrame, size: int, kind: str) -> np.ndarray:
    """The sum of all tasks' (part, sums) rows, as one array of ``size`` numbers."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in table:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                x = np.frombuffer(raw, dtype=kind).astype(np.float64)
                sums[part] = sums[part] + x if part in sums else x
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
            names=["part", "sums"],
        )

    out = np.zeros(size)
    rows = parts.repartition("part").mapInArrow(run, _MATRIX).collect()  # a fixed number of parts
    if rows:
        width = len(rows[0]["sums"]) // 8
        for row in rows:
            out[row["part"] * width :][:width] = np.frombuffer(row["sums"])
    return out


def _parts(matrix: np.ndarray, kind: str) -> tuple[list[int], list[bytes]]:
    """Blocks of rows that are not all 0."""
    used = [k for k in range(0, len(matrix), _PART) if matrix[k : k + _PART].any()]
    return [k // _PART for k in used], [matrix[k : k + _PART].astype(kind).tobytes() for k in used]


def _vocabularies(texts: DataFrame) -> DataFrame:
    """Per block its distinct words with their training count; and the tasks' neighbour counts.

    Rows (block, word, bucket, n) and rows (part, sums). A task holds one block's words at a time.
    """

    def counted(block: int, words: list, buckets: list, train: list) -> pa.RecordBatch:
        word, first, where = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        n = np.bincount(where, weights=np.concatenate(train), minlength=len(word)).astype(np.int64)
        size = len(word)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, block, dtype=np.int64)), pa.array(word.view(np.int64)),
                pa.array(np.concatenate(buckets)[first].astype(np.int32)), pa.array(n),
                pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
            ],
            names=["block", "word", "bucket", "n", "part", "sums"],
        )

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("lm_score")
        pairs = np.zeros(BUCKETS * BUCKETS, dtype=np.int64)
        block, words, buckets, train = None, [], [], []
        for whole in table:
            for batch in slices(whole, "text"):
                follow = []
                raws, learns = raw_texts(batch.column("text")), batch.column("train").to_numpy(zero_copy_only=False)
                blocks = batch.column("block").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(raws)]
                for lo, hi in itertools.pairwise(edges):
                    if blocks[lo] != block:
                        if words:
                            yield counted(block, words, buckets, train)
                        block, words, buckets, train = int(blocks[lo]), [], [], []
                    for few in _together(raws[lo:hi]):
                        w, k, last = tokens_together(raws[lo:hi][few])
                        learn = np.repeat(learns[lo:hi][few], np.diff(last, prepend=-1 - _GAP))  # a text after its gap
                        learn = np.append(learn[_GAP:], np.zeros(_GAP, dtype=bool))
                        at, word = k >= 0, (k >= 0) & (k < BUCKETS)
                        words.append(w[at])
                        buckets.append(k[at].astype(np.int16))
                        train.append(learn[at].astype(np.int8))
                        first = np.flatnonzero(word[:-1] & word[1:] & learn[:-1])
                        follow.append(k[first] * BUCKETS + k[first + 1])
                if follow:
                    pairs += np.bincount(np.concatenate(follow), minlength=BUCKETS * BUCKETS)
        if words:
            yield counted(block, words, buckets, train)
        part, sums = _parts(pairs.reshape(BUCKETS * BUCKETS // 64, 64), "<i8")
        none = len(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.int64()),
                pa.array(part, pa.int32()), pa.array(sums, pa.binary()),
            ],
            names=["block", "word", "bucket", "n", "part", "sums"],
        )

    dealt = texts.repartition("block").sortWithinPartitions("block").select("block", "text", "train")
    return dealt.mapInArrow(run, f"block long, word long, bucket int, n long, {_MATRIX}")


def _batches(table: Iterator[pa.RecordBatch], class_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and classes of about ``_STEP`` tokens of the texts at a time."""
    waiting, size = [], 0
    for whole in table:
        for batch in slices(whole, "text"):
            raws = raw_texts(batch.column("text"))
            for few in _together(raws):
                words, buckets, _ = tokens_together(raws[few])
                at = np.flatnonzero(buckets >= 0)
                waiting.append((features(words, buckets)[:, at], class_of[buckets[at]]))
                size += len(at)
                if size >= _STEP:
                    yield np.concatenate([x[0] for x in waiting], axis=1), np.concatenate([x[1] for x in waiting])
                    waiting, size = [], 0
    if size:
        yield np.concatenate([x[0] for x in waiting], axis=1), np.concatenate([x[1] for x in waiting])


def _class_counts(texts: DataFrame, class_of: np.ndarray) -> np.ndarray:
    """How often each feature (and, in the last row, any) is followed by each class."""
    shared = texts.sparkSession.sparkContext.broadcast(class_of)
    labels = CLASSES + 1

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("lm_score")
        seen = np.zeros((FEATURES + 1) * labels, dtype=np.int64)
        for found, truth in _batches(table, shared.value):
            seen[: FEATURES * labels] += np.bincount((found * np.int32(labels) + truth.astype(np.int32)).ravel(), minlength=FEATURES * labels)
            seen[FEATURES * labels :] += np.bincount(truth, minlength=labels)
        yield _sent(seen.reshape(-1, labels), "<u4")

    return _received(texts.select("text").mapInArrow(run, _MATRIX), labels, "<u4")


def _class_shares(texts: DataFrame, class_of: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How often the model expects each feature (and, in the last row, any) to be followed by each class."""
    shared = texts.sparkSession.sparkContext.broadcast((padded(weights), class_of))
    labels = CLASSES + 1

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept.only("lm_score")
        weights, class_of = shared.value
        total = np.zeros((labels, FEATURES + 1))  # whole numbers
        for found, _ in _batches(table, class_of):
            shares = np.empty((labels, found.shape[1]))  # a class in a row, as its sums are taken by itself
            for k in range(0, found.shape[1], _FEW):
                e = class_exponentials(weights, found[:, k : k + _FEW])[1][:, :labels].astype(np.float64)
                e *= (_UNIT / e.sum(axis=1))[:, None]
                shares[:, k : k + _FEW] = np.rint(e, out=e).T
            found = found.astype(np.intp)  # as bincount would for every class
            for parts, sums in zip(shares, total, strict=True):
                for f in found:
                    sums[:FEATURES] += np.bincount(f, weights=parts, minlength=FEATURES)
                sums[FEATURES] += parts.sum()
        yield _sent(total.T, "<f8")

    return _received(texts.select("text").mapInArrow(run, _MATRIX), labels, "<f8") / _UNIT


def _sent(matrix: np.ndarray, kind: str) -> pa.RecordBatch:
    part, sums = _parts(np.vstack([matrix, np.zeros((-len(matrix) % _PART, matrix.shape[1]), dtype=matrix.dtype)]), kind)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(sums, pa.binary())], names=["part", "sums"])


def _received(parts: DataFrame, width: int, kind: str) -> np.ndarray:
    rows = -(-(FEATURES + 1) // _PART) * _PART
    return _summed(parts, rows * width, kind).reshape(rows, width)[: FEATURES + 1]


def _trained(texts: DataFrame, class_of: np.ndarray, bias: np.ndarray, updates: int) -> np.ndarray:
    """Weights of the class factor, the bias in the last row, from this many updates over all texts."""
    counts = _class_counts(texts, class_of)
    seen = counts.sum(axis=1, keepdims=True)
    weights = _SHARE * (np.log((counts + _PRIOR * np.exp(bias)) / (seen + _PRIOR)) - bias)
    weights[FEATURES] = bias
    for _ in range(updates - 1):
        shares = _class_shares(texts, class_of, weights)
        curvature = shares * (1.0 - shares / np.maximum(seen, 1.0))
        weights = weights - _RATE * (shares - counts) / (curvature + _LEAST)
    return weights


def _scored(texts: DataFrame, counted: DataFrame, weights: np.ndarray, class_of: np.ndarray, stats: np.ndarray) -> DataFrame:
    """Blocks of texts beside their own part of the counts; ``stats``: tokens and words of each class."""
    shared = texts.sparkSession.sparkContext.broadcast((padded(weights), class_of, stats))
    kind = dict(texts.dtypes)["id"]

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        weights, class_of, stats = shared.value
        spread = np.log(stats[:, 0] + 0.5 * (stats[:, 1] + 1))
        whole = math.log10(stats[:, 0].sum() + 0.5 * (stats[:, 1].sum() + 1))
        vocabulary = counts.column("word").to_numpy().view(np.uint64)
        order = np.argsort(vocabulary)
        vocabulary, n = vocabulary[order], counts.column("c").to_numpy()[order]
        log_n, seen = np.log(n + 0.5), (n > 0).astype(np.int64)
        known, base, own, size = [], [], [], []

        def judge(waiting: list) -> None:
            words, classes = (np.concatenate([x[k] for x in waiting]) for k in (0, 1))
            found = np.concatenate([x[2] for x in waiting], axis=1)
            lengths = np.concatenate([x[3] for x in waiting])
            begins = np.cumsum(lengths) - lengths
            at = np.searchsorted(vocabulary, words)
            log_c = log_n[at]
            chosen = np.empty(len(words))
            for k in range(0, len(words), _FEW):
                logits, _, total = class_exponentials(weights, found[:, k : k + _FEW])
                own_class = classes[k : k + _FEW]
                chosen[k : k + _FEW] = logits[np.arange(len(own_class)), own_class].astype(np.float64) - np.log(total)
            size.append(lengths)
            known.append(np.add.reduceat(seen[at], begins))
            base.append(np.add.reduceat(log_c / math.log(10) - whole, begins))
            own.append(np.add.reduceat(chosen + log_c - spread[classes], begins) / math.log(10))

        waiting, held = [], 0
        raws = raw_texts(docs.column("text").combine_chunks())
        for few in _together(raws):
            words, buckets, last = tokens_together(raws[few])
            at = np.flatnonzero(buckets >= 0)
            lengths = np.diff(last, prepend=-1 - _GAP) - _GAP
            waiting.append((words[at], class_of[buckets[at]], features(words, buckets)[:, at], lengths))
            held += len(at)
            if held >= _STEP:
                judge(waiting)
                waiting, held = [], 0
        if waiting:
            judge(waiting)
        columns = [np.concatenate(x) if x else np.empty(0) for x in (size, known, base, own)]
        return pa.table(
            [
                docs.column("id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                pa.array(np.full(docs.num_rows, int(stats[:, 0].sum())), pa.int64()), pa.array(columns[2]), pa.array(columns[3]),
            ],
            names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return (
        texts.select("block", "id", "text").groupBy("block")
        .cogroup(counted.select("block", "word", "c").groupBy("block"))
        .applyInArrow(run, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )


def score(
    docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text", updates: int = 1
) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score.

    ``train_col`` names the boolean column that says which rows are learnt from (null: not). Scores
    are log10 probabilities of the whole text and its end; base_score is that of single words by
    their smoothed counts. Null and empty texts are an end alone. Repeated rows each count and each
    give a row. Without any training row, every token is unknown. Columns of other names are
    ignored; an empty table gives no rows. ``updates``: gradient updates of the class factor, each over
    all training rows; ``UPDATES`` are what ``op7`` takes.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(train_col), F.lit(False)).alias("train")
    )
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    row_hash = F.xxhash64("id", "text")
    texts = rows.withColumn("block", F.pmod(row_hash, F.lit(blocks)))

    gathered = hold(_vocabularies(texts), "vocabularies")
    pairs = _summed(gathered.where("part is not null").select("part", "sums"), BUCKETS * BUCKETS, "<i8")
    class_of = _class_of(pairs.reshape(BUCKETS, BUCKETS))
    same = W.partitionBy("word")  # at most a row per block
    counted = hold(
        gathered.where("word is not null").select(
            "block", "word", F.element_at(F.lit(class_of.tolist()), F.col("bucket") + 1).alias("class"),
            F.sum("n").over(same).alias("c"), (F.min("block").over(same) == F.col("block")).alias("once"),
        ),
        "counts",
    )
    stats = np.zeros((CLASSES + 1, 2))
    sums = counted.where("once").groupBy("class").agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"))
    for row in sums.collect():  # one row per class
        stats[row["class"]] = row["n"], row["v"]

    weights = np.zeros((FEATURES + 1, CLASSES + 1))
    weights[FEATURES] = np.log((stats[:, 0] + 1) / (stats[:, 0] + 1).sum())
    if stats[:, 0].sum():
        weights = _trained(texts.where("train"), class_of, weights[FEATURES], updates)
    return _scored(texts, counted, weights, class_of, stats).withColumnRenamed("id", id_col)

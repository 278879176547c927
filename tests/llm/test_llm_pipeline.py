from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
from awkward import LOWER, frame, words
from test_llm_near import expected as near_expected
from test_llm_suffixes import coverage

from supplylens.functions import workspace
from supplylens.functions.workspace import hold
from supplylens.llm.vocabularies import vocabulary
from supplylens.llm.word_tokens import word_tokens
from supplylens.sources import files


def stages(spark, docs, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(hold(stage(spark, out[-1], folder), name))
    return out


def test_each_stage_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    raw, known, exact, near, cut, packed = [x.collect() for x in stages(spark, docs, small)]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "ngram_jaccard", "suffix_array_dedup", "best_fit_packing"
    ]
    # language: clean documents stay
    assert {r.doc_id for r in known} <= {r.doc_id for r in raw} and len(known) > 0.98 * len(raw)
    # exact: the largest id of each text
    best: dict[str, int] = {}
    for r in known:
        t = r.text.translate(LOWER)
        best[t] = max(best.get(t, -1), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(best.values())
    # near: the smallest id of each component
    components = near_expected([(r.doc_id, r.text) for r in exact], 5, 4, 5)
    assert sorted(r.doc_id for r in near) == sorted(i for _, i, _, c in components if i == c)
    # passages: none left in two documents, none lost
    left = [(r.doc_id, r.text) for r in cut]
    assert not coverage(left, 50)
    assert {w for r in near for w in words(r.text)} == {w for _, t in left for w in words(t)}
    repeated = coverage([(r.doc_id, r.text) for r in near], 50)
    before, after = ({r.doc_id: len(words(r.text)) for r in x} for x in (near, cut))
    assert all(before[i] - after.get(i, 0) <= len(repeated.get(i, ())) for i in before)
    assert all(r.n_chars == len(r.text) for r in cut)
    # packing: every token once, in order, nothing over capacity
    own = word_tokens(vocabulary("word_bpe_49k.json"))
    length = {i: len(own.tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left}
    total = Counter()
    for r in packed:
        total[r.doc_id] += r.length
    assert total == length
    used = Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096
    assert len(used) == -(-int(np.sum(list(length.values()))) // 4096)


def test_columns_and_empty_documents(spark, awkward, nothing, small):
    for docs in (awkward, nothing):
        made = stages(spark, docs, small)
        assert all(x.columns == docs.columns for x in made[:-1])
        assert all(x.count() >= y.count() for x, y in zip(made[:-2], made[1:-1], strict=True))
    assert made[-1].count() == 0


def test_run_leaves_its_result_alone(spark, small):
    mark = workspace.written()
    out = corpus_pipeline.run(spark, small)
    assert out.columns[:4] == ["doc_id", "piece", "start", "length"] and out.count() > 100
    left = [p for p in workspace._FOLDERS[mark:] if files.exists(spark, p)]
    assert len(left) == 1 and "best_fit_packing" in left[0]


def test_frame_has_the_document_columns(spark):
    assert set("doc_id text lang source n_chars".split()) <= set(frame(spark, []).columns)

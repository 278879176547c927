from __future__ import annotations

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from supplylens.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """(root, for each node its siblings as (left, right) from the lowest level up)."""
    paths, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, above = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for k in range(len(run)):
                for leaf in owners[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h("".join(run)))
            above.append([leaf for k in range(len(run)) for leaf in owners[at + k]])
        nodes, owners = up, above
    return nodes[0], paths


def expected(rows, change):
    """Counter of (id, source, leaf, subroot, root, proof, folded, verified); rows are dicts of FIELDS."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"], h("".join(field(r[f]) for f in FIELDS)), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([leaf for _, leaf, _ in groups[s]])
    root, tops = tree([trees[s][0] for s in names]) if names else (None, [])
    out = Counter()
    for s, top in zip(names, tops, strict=True):
        for (i, leaf, r), path in zip(groups[s], trees[s][1], strict=True):
            whole = path + top
            node = h("".join(field(v) for v in change(r)))
            for left, right in whole:
                node = h(left + node + right)
            proof = h("".join(left + right for left, right in whole))
            out[i, s, leaf, trees[s][0], root, proof, node, node == root] += 1
    return out


def tampered(r):
    text = r["text"]
    if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
        text = text.replace("\n", "")
    return [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]


def changed():
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return {"text": F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def have(docs):
    found = merkle.manifest(docs, changed=changed()).withColumn("proof", merkle.proof_digest(F.col("path")))
    names = ["doc_id", "source", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    return Counter(tuple(r) for r in found.select(names).collect())


def dicts(docs):
    return [r.asDict() for r in docs.select(*FIELDS).collect()]


def test_awkward_rows_equal_brute_force(awkward):
    assert have(awkward) == expected(dicts(awkward), tampered)


@pytest.mark.parametrize("levels", [1, 2])
def test_trees_of_many_chunks_equal_brute_force(spark, monkeypatch, levels):
    """Small chunks: chunks of chunks; a third of the rows in one source, lone sources, a null one."""
    monkeypatch.setattr(merkle, "CHUNK_LEVELS", levels)
    docs = spark.range(0, 260, 1, 6).select(
        ((F.col("id") * 37) % 263).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 130, F.concat(F.lit("s"), F.col("id") % 29)).alias("source"),
        F.lit(None).cast("string").alias("lang"),
        F.col("id").alias("n_chars"),
        F.concat(F.lit("a\nb"), F.col("id")).alias("text"),
    )
    assert have(docs) == expected(dicts(docs), tampered)


@pytest.mark.parametrize("sources", [[None], ["a"], ["a", "b"], ["", None, "é", "z"]])
def test_lone_leaves_and_few_sources(spark, sources):
    rows = [(k, s, "en", None, "x\ny") for k, s in enumerate(sources)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert have(docs) == expected(dicts(docs), tampered)


def test_equal_rows_are_leaves_of_their_own(spark):
    docs = spark.range(100).selectExpr("1L doc_id", "'s' source", "'en' lang", "1L n_chars", "'same' text")
    found = have(docs)
    assert found == expected(dicts(docs), tampered) and sum(found.values()) == 100


def test_empty_table(nothing):
    assert merkle.manifest(nothing).count() == 0


def test_any_changed_field_is_noticed(awkward):
    found = merkle.manifest(awkward.where("doc_id is not null").dropDuplicates(["doc_id"]), changed={"n_chars": F.when(F.col("doc_id") == 9, 5)})
    assert [r.doc_id for r in found.where("not verified").collect()] == [9]

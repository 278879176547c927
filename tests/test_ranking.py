"""The range-split order against one plain window, with hot ties and NULLs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from supplylens.functions import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of which a third share one value."""
    value = F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 37 % 501).cast("double"))
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 11 != 0, value).alias("v"),
        (F.col("id") % 13).cast("double").alias("u"),
    )


def test_running_sum_equals_plain_window(skewed):
    order = [F.col("v"), F.col("id")]
    got = ranking.running_sum(skewed, order, F.col("id"), "s")
    plain = skewed.withColumn(
        "s", F.sum("id").over(W.partitionBy(F.lit(0)).orderBy("v", "id").rowsBetween(W.unboundedPreceding, 0))
    )
    assert sorted(map(tuple, got.select("id", "s").collect())) == sorted(map(tuple, plain.select("id", "s").collect()))


def test_running_sum_adds_tied_rows_one_by_one(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "id int, x double")
    got = ranking.running_sum(df, [-F.col("x"), F.col("id")], F.col("x"), "s")
    assert {r.id: r.s for r in got.collect()} == {1: 5.0, 2: 10.0, 3: 11.0}


def test_row_numbers(skewed):
    got = ranking.row_numbers(skewed, [F.col("v"), F.col("id")], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 3001))
    keys = [(-1 if r.v is None else r.v, r.id) for r in got]
    assert keys == sorted(keys)


def test_quantiles_match_linear_interpolation(skewed):
    probes = {f"q{i}": ("v", p) for i, p in enumerate([0.0, 0.1, 0.15, 0.5, 0.85, 1.0])}
    row = ranking.quantiles(skewed, {**probes, "u": ("u", 0.3)}).first()
    pdf = skewed.toPandas()
    for name, (_, p) in probes.items():
        assert row[name] == pdf.v.quantile(p)
    assert row.u == pdf.u.quantile(0.3)


def test_quantiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert ranking.quantiles(df, {"q": ("v", 0.5)}).first().q is None


def test_percent_rank_averages_ties_and_keeps_nulls(spark):
    values = [1.0, 2.0, 2.0, None, 5.0]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "k int, a double, b double")
    got = {r.k: (r.a, r.b) for r in ranking.percent_ranks(df, ["k"], {"a": True, "b": False}).collect()}
    expected = pd.Series(values).rank(pct=True, method="average")
    for k in (0, 1, 2, 4):
        assert got[k] == (expected[k], 1 - expected[k])
    assert 3 not in got  # nothing to rank; the caller's left join gives NULL


def test_percent_rank_with_a_hot_value(skewed):
    got = ranking.percent_ranks(skewed, ["id"], {"v": True}).orderBy("id").toPandas()
    pdf = skewed.orderBy("id").toPandas()
    expected = pdf.v.rank(pct=True, method="average").dropna().to_numpy()
    assert np.array_equal(got.v.to_numpy(), expected)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 7, 8, 100, 101, 102])
def test_thirds_match_quantile_cuts(spark, n):
    df = spark.range(n).select((F.col("id") % 2).alias("q"), "id")
    got = ranking.thirds(df, [F.col("q"), F.col("id")], ("S", "M", "L"), "c")
    counts = {r.c: r["count"] for r in got.groupBy("c").count().collect()}
    expected = pd.qcut(pd.Series(range(1, n + 1)).astype(float), 3, labels=["S", "M", "L"]).value_counts()
    assert counts == expected.to_dict()


@pytest.fixture(params=[3, 40])
def ranges(spark, request):
    """So many ranges, none merged with the next."""
    conf = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_ranges_ascend_and_equal_keys_share_one(skewed, ranges):
    found = ranking.with_range(skewed.repartition(5), [F.col("v"), F.col("u")]).orderBy("v", "u", "_range").collect()
    assert len(found) == 3000 and len({r._range for r in found}) >= min(ranges, 3)
    assert [r._range for r in found] == sorted(r._range for r in found)
    assert len({(r.v, r.u) for r in found}) == len({(r.v, r.u, r._range) for r in found})


def test_more_ranges_change_nothing(skewed, ranges):
    test_running_sum_equals_plain_window(skewed)
    test_row_numbers(skewed)
    test_quantiles_match_linear_interpolation(skewed)
    test_percent_rank_with_a_hot_value(skewed)


def test_a_tie_over_many_ranges_has_one_place(skewed, ranges):
    """The value 7 fills whole ranges; every cell of it has the same rows below and ties."""
    cells = ranking.cell_ranks(skewed, ["id"], ["v", "u"]).toPandas()
    pdf = skewed.toPandas()
    for column in ("v", "u"):
        known = pdf[["id", column]].dropna()
        got = cells[cells.metric == column].set_index("id").sort_index()
        want = known.set_index("id")[column].sort_index()
        assert (got.value == want).all() and (got.total == len(known)).all()
        assert (got.below == want.rank(method="min") - 1).all()
        assert (got.ties == want.groupby(want).transform("size")).all()
    probes = {"a": ("v", 0.37), "b": ("v", 0.5), "c": ("u", 0.9)}
    row = ranking.quantiles_of(ranking.cell_ranks(skewed, ["id"], ["v", "u"]), probes).first()
    assert [row[n] for n in probes] == [pdf[c].quantile(p) for c, p in probes.values()]


def test_ranked_rows_rank_and_add_up_at_once(skewed, ranges):
    got = ranking.ranked_rows(skewed.where("v is not null"), -F.col("v"), ["id"], {"s": F.col("id")}).toPandas().sort_values("id")
    pdf = skewed.where("v is not null").toPandas().sort_values(["v", "id"], ascending=[False, True])
    pdf["s"], pdf["below"] = pdf.id.cumsum(), pdf.v.rank(method="min", ascending=False) - 1
    pdf = pdf.sort_values("id")
    assert got.s.tolist() == pdf.s.tolist() and got.below.tolist() == pdf.below.tolist()
    assert set(got.s_total) == {pdf.id.sum()} and set(got.total) == {len(pdf)}


def test_scores_in_order_give_their_own_percentiles(skewed, ranges):
    held = ranking.with_range(skewed, ["v", "id"])
    row = ranking.quantiles_of(ranking.ranks_in(held, "v"), {"q": ("v", 0.75)}).first()
    assert row.q == skewed.toPandas().v.quantile(0.75)


def test_sums_before_a_row_in_its_group(spark, ranges):
    """One group has a third of all rows and fills whole ranges; one has a NULL key."""
    group = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 20)
    df = spark.range(2000).select("id", group.alias("g"), (F.col("id") % 5).alias("x"))
    got = ranking.earlier_in_group(df, ["g"], ["id"], F.col("x"), "s")
    plain = W.partitionBy("g").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("x").over(plain), F.lit(0)))
    assert sorted(map(str, got.select("id", "g", "s").collect())) == sorted(map(str, want.select("id", "g", "s").collect()))

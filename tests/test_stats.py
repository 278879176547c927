"""Statistics against brute force on small inputs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from supplylens.operators import stats


@pytest.fixture(scope="module")
def sample(spark):
    return spark.range(200).select(
        "id",
        F.when(F.col("id") % 17 != 0, (F.col("id") * 31 % 97).cast("double")).alias("a"),
        F.when(F.col("id") % 19 != 0, F.sqrt("id")).alias("b"),
        F.lit(3.0).alias("c"),
    )


@pytest.mark.parametrize(
    ("t", "df", "p"), [(2.0, 10.0, 0.0733880), (2.2281389, 10.0, 0.05), (1.0, 1.0, 0.5), (0.0, 5.0, 1.0)]
)
def test_two_sided_p(t, df, p):
    assert abs(stats.t_two_sided(t, df) - p) < 1e-6


@pytest.mark.parametrize(("df", "t"), [(1, 12.7062047), (10, 2.2281389), (30, 2.0422725), (100000, 1.9599877)])
def test_critical_value(df, t):
    assert abs(stats.t_critical(0.95, df) - t) < 1e-5


def test_describe(sample):
    got = {r.ColumnName: r for r in stats.describe(sample, ["a", "b", "c"]).collect()}
    pdf = sample.toPandas()
    for c in ("a", "b", "c"):
        d = pdf[c].describe()
        r = got[c]
        mine = [r["count"], r["mean"], r["std"], r["min"], r.p25, r.p50, r.p75, r["max"]]
        assert np.allclose(mine, d.to_numpy(), rtol=1e-12)


def test_histogram(sample):
    rows = stats.histogram(sample, ["a", "c"], bins=30).collect()
    pdf = sample.toPandas()
    for c in ("a", "c"):
        counts, edges = np.histogram(pdf[c].dropna(), bins=30)
        mine = sorted((r.Bin, r.Rows, r.LowerEdge) for r in rows if r.ColumnName == c)
        assert [n for _, n, _ in mine] == counts.tolist()
        assert np.allclose([e for _, _, e in mine], edges[:-1])


def test_density(sample):
    rows = stats.density(sample, ["a", "c"], points=50, cut=3.0).orderBy("Point").collect()
    x = sample.toPandas().a.dropna().to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 50)
    expected = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert {r.ColumnName for r in rows} == {"a"}  # a constant column has no curve
    assert np.allclose([r.X for r in rows], grid) and np.allclose([r.Density for r in rows], expected)


def test_boxplot(sample):
    r = stats.boxplot(sample.withColumn("a", F.when(F.col("id") == 1, 1e6).otherwise(F.col("a"))), ["a"]).first()
    x = sample.toPandas().a.where(sample.toPandas().id != 1, 1e6).dropna()
    q1, q3 = x.quantile(0.25), x.quantile(0.75)
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (r.Q1, r.Q3, r.LowerWhisker, r.UpperWhisker) == (q1, q3, inside.min(), inside.max())
    assert r.Outliers == len(x) - len(inside) == 1


def test_correlation_is_pairwise_complete(sample):
    got = {(r.ColumnA, r.ColumnB): r.Correlation for r in stats.correlation(sample, ["a", "b", "c"]).collect()}
    expected = sample.toPandas()[["a", "b", "c"]].corr()
    assert len(got) == 9
    assert abs(got["a", "b"] - expected.loc["a", "b"]) < 1e-12 and got["a", "b"] == got["b", "a"]
    assert abs(got["a", "a"] - 1.0) < 1e-12 and got["a", "c"] is None


def test_welch_and_interval(spark):
    top, low = [1.0, 2.0, 3.0, 4.0], [2.0, 2.5, 8.0]
    rows = [("Top", x) for x in top] + [("Low", x) for x in low]
    groups = spark.createDataFrame(rows, "SalesGroup string, ProfitMargin double")
    w = stats.welch_test(groups).first()
    va, vb = np.var(top, ddof=1) / 4, np.var(low, ddof=1) / 3
    t = (np.mean(top) - np.mean(low)) / math.sqrt(va + vb)
    df = (va + vb) ** 2 / (va**2 / 3 + vb**2 / 2)
    assert abs(w.TStatistic - t) < 1e-12 and abs(w.DegreesOfFreedom - df) < 1e-12
    assert not w.RejectEqualMeans
    ci = {r.SalesGroup: r for r in stats.confidence_intervals(groups).collect()}
    assert abs(ci["Top"].Upper - (2.5 + 3.182446305 * np.std(top, ddof=1) / 2)) < 1e-6


def test_quarters_may_share_a_vendor(spark):
    df = spark.createDataFrame([(1.0, 5.0)], "TotalSalesDollars double, ProfitMargin double")
    assert sorted(r.SalesGroup for r in stats.sales_groups(df).collect()) == ["Low", "Top"]

"""One small literal per NULL, rounding and tie rule."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from supplylens.functions import exprs
from supplylens.functions.frames import merge_inner, merge_left, with_scalars
from supplylens.operators import (
    audit,
    charts,
    dims,
    eda,
    inventory,
    leadtime,
    orders,
    quality,
    risk,
    scorecard,
    summary,
    vendors,
)

D = dt.date


def test_sum_of_nulls_is_zero_or_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 0.1), (2, 0.2)], "k int, x double")
    got = df.groupBy("k").agg(exprs.sum_or_zero("x").alias("z"), exprs.sum_or_null("x").alias("n"))
    assert {tuple(r) for r in got.collect()} == {(1, 0.0, None), (2, 0.3, 0.3)}


def test_merge_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(None, 7), (1, 8)], "k int, w int")
    assert {tuple(r) for r in merge_left(left, right, ["k"]).collect()} == {(1, "a", 8), (None, "b", 7)}
    assert merge_inner(left, right, ["k"]).count() == 2


def test_duplicate_grain_raises(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2)], "a int, b int")
    with pytest.raises(quality.DataQualityError):
        quality.assert_unique(df, ["a", "b"], "t")
    quality.assert_unique(df.distinct(), ["a", "b"], "t")


def test_null_keys_count_as_repeated(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    row = quality.duplicate_counts(df, ["a", "b"]).first()
    assert (row.DistinctKeys, row.RepeatedKeys, row.SurplusRows) == (2, 1, 1)


def test_division_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (1.0, 4.0), (None, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(exprs.ratio("n", "d", 100.0)).collect()] == [None, None, 25.0, None]


def test_trim_variants(spark):
    df = spark.createDataFrame([("\t a b \n",)], "s string")
    assert df.select(exprs.trim_spaces("s")).first()[0] == "\t a b \n"
    assert df.select(exprs.strip_whitespace("s")).first()[0] == "a b"


@pytest.mark.parametrize("token", exprs.NULL_TOKENS)
def test_null_tokens(spark, token):
    df = spark.createDataFrame([(token,), (f" {token}x",)], "s string")
    assert [r[0] for r in df.select(exprs.null_tokens_to_null("s")).collect()] == [None, f" {token}x"]


def test_aging_buckets_and_negative_days(spark):
    days = [-1, 0, 7, 8, 15, 16, 30, 31, 60, 61, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    strict = [r[0] for r in df.select(exprs.aging_bucket("d")).collect()]
    loose = [r[0] for r in df.select(exprs.aging_bucket_open("d")).collect()]
    expected = ["0-7 days"] * 2 + ["8-15 days"] * 2 + ["16-30 days"] * 2 + ["31-60 days"] * 2 + ["60+ days", None]
    assert strict == [None, *expected]
    assert loose == ["0-7 days", *expected]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (None,)], "x double")
    assert [r[0] for r in df.select(exprs.half_even("x")).collect()] == [0.12, 0.38, -0.12, None]


def test_currency_labels(spark):
    df = spark.createDataFrame([(1_234_567.0,), (1_500.0,), (999.5,), (None,)], "x double")
    assert [r[0] for r in df.select(exprs.currency_label("x")).collect()] == ["1.23M", "1.50K", "999.5", None]


def test_sample_variance_of_one_value_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (2, 9)], "k int, x long")
    v = exprs.sample_variance(F.count("x"), F.sum("x"), F.sum(F.col("x") * F.col("x")))
    assert {tuple(r) for r in df.groupBy("k").agg(v).collect()} == {(1, None), (2, 8.0)}


def test_unknown_conditions_are_zero(spark):
    df = spark.createDataFrame([(None,), (3.0,), (1.0,)], "x double")
    assert [r[0] for r in df.select(exprs.holds(F.col("x") > 2)).collect()] == [0, 1, 0]


def test_tolerance(spark):
    df = spark.createDataFrame([(1.0, 1.009), (1.0, 1.02), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(exprs.within("a", "b", 0.01)).collect()] == [True, False, None]


def test_scalars_of_an_empty_frame_are_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    none = spark.createDataFrame([], "m double")
    assert tuple(with_scalars(df, none).first()) == (1, None)


PURCHASES = "VendorNumber long, PONumber long, VendorName string, PODate date, ReceivingDate date, InvoiceDate date, PayDate date, Quantity long, Dollars double"
INVOICES = "VendorNumber long, PONumber long, VendorName string, PODate date, InvoiceDate date, PayDate date, Quantity long, Dollars double, Freight double"


def test_purchase_orders_against_invoices(spark):
    day = D(2024, 1, 10)
    bought = spark.createDataFrame(
        [
            (1, 10, " A ", day, D(2024, 1, 15), None, None, 2, 10.0),
            (1, 10, "A", day, D(2024, 1, 18), D(2024, 1, 20), None, 3, 5.5),
            (1, 11, "A", day, None, None, None, 1, 1.0),
            (2, 12, "B", day, D(2024, 1, 11), None, None, 1, 1.0),
            (2, 12, "B", D(2024, 1, 9), D(2024, 1, 11), None, None, 1, 1.0),
            (None, 13, "N", day, day, None, None, 1, 1.0),
        ],
        PURCHASES,
    )
    billed = spark.createDataFrame(
        [
            (1, 10, "A", day, D(2024, 1, 21), None, 5, 15.0, 0.5),
            (3, 14, "C", day, D(2024, 1, 22), None, 1, 1.0, 0.1),
            (None, 13, "N", day, None, None, 1, 1.0, 0.1),
        ],
        INVOICES,
    )
    po = orders.enhance_purchase_orders(orders.purchase_order_summary(bought, billed))
    rows = {(r.VendorNumber, r.PONumber, r.PurchaseOrderMatchStatus): r for r in po.collect()}
    assert set(rows) == {
        (1, 10, "Matched"), (1, 11, "Purchase only"), (2, 12, "Purchase only"),
        (None, 13, "Purchase only"), (None, 13, "Invoice only"), (3, 14, "Invoice only"),
    }
    match = rows[(1, 10, "Matched")]
    assert match.VendorName == "A"
    assert match.ObservedLeadTimeDays == 8 and match.POCycleAgingBucket == "8-15 days"
    assert match.PurchaseLineCount == 2 and match.PurchaseDollars == 15.5
    assert match.InvoiceDate == D(2024, 1, 20) and match.POToInvoiceDays == 10
    assert match.QuantityReconciliationFlag == "Quantity aligned"
    assert match.DollarReconciliationFlag == "Invoice dollars below purchase dollars"
    assert rows[(2, 12, "Purchase only")].ObservedLeadTimeDays is None
    assert rows[(1, 11, "Purchase only")].QuantityReconciliationFlag == "Not matched"
    delivery = {r.VendorName: r for r in orders.delivery_reconciliation(po).collect()}
    assert delivery["A"].InvoiceMatchRatePct == 50.0 and delivery["A"].DollarAlignmentRatePct == 0.0
    assert delivery["C"].QuantityAlignmentRatePct is None


def test_consistent_reference_price_or_null(spark):
    prices = spark.createDataFrame(
        [(1, 1, 9.0, 7.0, "750"), (1, 1, 9.0, 8.0, "Unknown"), (1, 2, 1.0, 1.0, "Unknown")],
        "VendorNumber long, Brand long, Price double, PurchasePrice double, Volume string",
    )
    rows = {r.Brand: (r.ActualPrice, r.ReferencePurchasePrice, r.Volume) for r in summary.price_summary(prices).collect()}
    assert rows == {1: (9.0, None, 750.0), 2: (1.0, 1.0, None)}


def test_vendor_brand_summary_rules(spark):
    bought = spark.createDataFrame(
        [
            (1, 1, "A", "x", 10, 100.0, 10.0),
            (1, 1, "A ", "x", 5, 0.0, 0.0),
            (1, 2, "A", "y", 4, 40.0, 0.0),
            (None, 3, "N", "z", 1, 1.0, 1.0),
        ],
        "VendorNumber long, Brand long, VendorName string, Description string, Quantity long, Dollars double, PurchasePrice double",
    )
    sold = spark.createDataFrame(
        [
            (1, 1, "A", "x", 60.0, 4, 1.0, 15.0),
            (1, 2, "A", "y", 30.0, 3, 0.5, 10.0),
            (2, 1, "B", "x", 15.0, 1, 0.1, 15.0),
            (None, 3, "N", "z", 1.0, 1, 0.0, 1.0),
        ],
        "VendorNo long, Brand long, VendorName string, Description string, SalesDollars double, SalesQuantity long, ExciseTax double, SalesPrice double",
    )
    prices = spark.createDataFrame(
        [(1, 1, 20.0, 8.0, "750")], "VendorNumber long, Brand long, Price double, PurchasePrice double, Volume string"
    )
    invoices = spark.createDataFrame([(1, 14.0)], "VendorNumber long, Freight double")
    stock = spark.createDataFrame(
        [(1, 2, 2, 8.0, 4.0, 40.0), (2, 2, 1, 5.0, 5.0, 10.0)],
        "Brand long, StoreCount long, CompleteStoreCount long, AverageInventoryUnits double, EndingInventoryUnits double, EndingInventoryRetailValue double",
    )
    out = summary.vendor_sales_summary(bought, sold, prices, invoices, stock)
    rows = {(r.VendorNumber, r.Brand): r for r in out.collect()}
    assert set(rows) == {(1, 1), (1, 2), (2, 1), (None, 3)}
    a = rows[(1, 1)]
    assert a.PurchasePrice == 10.0 and a.CostCoveredPurchaseQuantity == 10.0 and a.TotalPurchaseQuantity == 15.0
    assert a.GrossProfit == 60.0 - 4 * 10.0 and abs(a.ProfitMargin - 100 / 3) < 1e-12
    assert a.FreightCost == 10.0 and a.PurchasePriceVariancePct == 25.0
    assert a.StockTurnover == 0.5 and a["Unsold Capital"] == 40.0
    free = rows[(1, 2)]
    assert free.PurchasePrice is None and free.UncostedSalesDollars == 30.0 and free.GrossProfit is None
    assert free.StockTurnover is None  # not every position is in both snapshots
    assert rows[(2, 1)].TotalPurchaseDollars == 0.0 and rows[(2, 1)].StockTurnover is None
    # A key with a NULL part is kept once and matches neither side.
    lost = rows[(None, 3)]
    assert lost.TotalPurchaseDollars == 0.0 and lost.TotalSalesDollars == 0.0 and lost.VendorName is None


def test_inventory_rules(spark):
    schema = "Store long, Brand long, onHand long, Price double"
    begin = spark.createDataFrame([(1, 1, 3, 2.0), (1, 1, 1, 2.0), (2, 1, 0, 2.0), (None, 1, 1, 1.0)], schema)
    end = spark.createDataFrame([(1, 1, 0, 2.5), (3, 1, 4, 2.5), (None, 1, 1, 1.0)], schema)
    position = inventory.inventory_summary(inventory.inventory_position(begin, end))
    rows = {(r.Store, r.BeginningUnits): r for r in position.collect()}
    assert len(rows) == 5  # the NULL store of each side stays apart
    both = rows[(1, 4.0)]
    assert both.AverageInventoryUnits == 2.0 and both.LowInventoryFlag == 1
    assert both.InventoryMovementUnits == -4.0 and both.HasBothSnapshots == 1
    assert rows[(2, 0.0)].BeginningAvailable == 0 and rows[(2, 0.0)].EndingAvailable is None
    by_brand = inventory.inventory_by_brand(position).first()
    assert (by_brand.StoreCount, by_brand.CompleteStoreCount) == (5, 1)


def test_top_ten_goes_by_vendor_number(spark):
    rows = [(n, f"V{n}", 1000.0 - n) for n in range(1, 13)] + [(1, "V1 LTD", 1.0)]
    df = spark.createDataFrame(rows, "VendorNumber long, VendorName string, TotalPurchaseDollars double")
    got = {r["Vendor Category"]: r for r in vendors.vendor_purchase_summary(df).collect()}
    assert got["V1 LTD"].TotalPurchaseDollars == 1.0  # another spelling of a top vendor
    assert got["Others"].TotalPurchaseDollars == 989.0 + 988.0
    assert [n for n, r in got.items() if r.Top10Cont] == ["Others"]  # the largest category
    total = sum(r[2] for r in rows)
    assert abs(got["Others"].Top10Cont - (total - 1977.0) / total * 100) < 1e-9


def test_high_cycle_count_repeats_per_spelling(spark):
    po = spark.createDataFrame(
        [(1, 10), (1, 2), (2, 3), (2, 9), (None, 11)], "VendorNumber long, ObservedLeadTimeDays int"
    )
    got = {tuple(r) for r in risk.high_cycle_counts(po).collect()}
    assert got == {(1, 1)}  # third quartile is 10; rows without a vendor are dropped


def test_scorecard_score_needs_evidence_and_status_follows_percentiles(spark):
    rows = [
        (i, f"V{i}", 5 if i else 4, float(i), 50.0 + i, None if i == 3 else 100.0, 1.0, 10.0)
        for i in range(8)
    ]
    base = spark.createDataFrame(
        rows,
        "VendorNumber long, VendorName string, ObservedLeadTimeOrderCount long, LeadTimeConsistencyScore double, InvoiceMatchRatePct double, QuantityAlignmentRatePct double, AbsoluteAvgPriceVariancePct double, MedianLeadTimeDays double",
    )
    scored = scorecard.performance_status(scorecard.composite_scores(base))
    got = {r.VendorNumber: r for r in scored.collect()}
    assert got[0].SupplierPerformanceScore is None and got[0].PerformanceStatus == "Insufficient data"
    # Ranks compare all eight rows: consistency 8/8, match 8/8, alignment tied 4/7, and the
    # two "lower is better" parts all tied at 1 - 4.5/8.
    assert abs(got[7].SupplierPerformanceScore - (1 + 1 + 4 / 7 + 2 * (1 - 4.5 / 8)) / 5 * 100) < 1e-9
    assert abs(got[3].SupplierPerformanceScore - (4 / 8 + 4 / 8 + 2 * (1 - 4.5 / 8)) / 4 * 100) < 1e-9
    assert got[7].PerformanceStatus == "High Performing"
    assert got[1].PerformanceStatus == "Underperforming"


def test_nobody_eligible_keeps_threshold_columns(spark):
    scores = spark.createDataFrame([(1, "A", None)], "VendorNumber long, VendorName string, SupplierPerformanceScore double")
    row = scorecard.performance_status(scores).first()
    assert row.PerformanceStatus == "Insufficient data" and row.ScoreThresholdP75 is None


def test_lead_time_consistency_of_one_order(spark):
    detail = spark.createDataFrame(
        [(1, "A", 5, 13, 17.0, 0)],
        "VendorNumber long, VendorName string, PONumber long, ObservedLeadTimeDays int, PurchaseDollars double, LeadTimeOutlierFlag int",
    )
    row = leadtime.supplier_lead_times(detail).first()
    assert row.LeadTimeStdDevDays is None and row.LeadTimeConsistencyScore == 1.0


def test_brand_lead_times_count_distinct_orders(spark):
    lines = spark.createDataFrame(
        [(1, 7, 5, "x"), (1, 7, 5, " x"), (2, 7, 5, "x"), (None, 8, 5, "x")],
        "VendorNumber long, PONumber long, Brand long, Description string",
    )
    po = spark.createDataFrame(
        [(1, 7, 4), (2, 7, 6), (None, 8, 8)], "VendorNumber long, PONumber long, ObservedLeadTimeDays int"
    )
    row = leadtime.brand_lead_times(lines, po).first()
    assert (row.ObservedLeadTimeOrderCount, row.PurchasingVendorCount) == (2, 2)
    assert (row.AverageLeadTimeDays, row.MedianLeadTimeDays) == (6.0, 6.0)  # NULL meets NULL


def test_date_dimension(spark):
    bounds = spark.createDataFrame([(D(2023, 12, 31), D(2024, 1, 1))], "lo date, hi date")
    rows = dims.dim_date(bounds).collect()
    assert [tuple(r) for r in rows] == [
        (D(2023, 12, 31), 20231231, 2023, 12, "Dec", "2023-12", 4),
        (D(2024, 1, 1), 20240101, 2024, 1, "Jan", "2024-01", 1),
    ]
    assert dims.dim_date(spark.createDataFrame([(None, None)], "lo date, hi date")).count() == 0


def test_fill_keeps_text(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    assert tuple(eda.fill_numbers(df).first()) == (0.0, None)


def test_untrimmed_counts_nulls_as_unclean(spark):
    df = spark.createDataFrame([("a",), (" a",), (None,)], "s string")
    assert eda.untrimmed_counts(df, ["s"]).first().Untrimmed == 2


def test_reference_rows_scale_purchases(spark):
    bought = spark.createDataFrame(
        [(1, "A", 1, "x", 2, 10.0, 5.0)],
        "VendorNumber long, VendorName string, Brand long, Description string, Quantity long, Dollars double, PurchasePrice double",
    )
    prices = spark.createDataFrame(
        [(1, 1, "750", 9.0), (1, 1, "Unknown", 8.0)], "VendorNumber long, Brand long, Volume string, Price double"
    )
    row = eda.purchases_with_reference(bought, prices).first()
    assert (row.TotalPurchaseQuantity, row.TotalPurchaseDollars, row.WeightedPurchasePrice) == (4, 20.0, 5.0)
    assert (row.Volume, row.ReferencePrice) == ("Unknown", 9.0)


def test_type_profile(spark):
    df = spark.createDataFrame([(i, str(i), "x", "1" if i % 5 else "?") for i in range(40)], "k int, a string, b string, c string")
    got = {r.ColumnName: r.DataType for r in eda.type_profile(df, ["k"]).collect()}
    assert got == {"k": "DOUBLE", "a": "DOUBLE", "b": "STRING", "c": "STRING"}


def test_validation_raises_on_mismatch_and_on_filled_otif(spark):
    po = spark.createDataFrame([(1, 4)], "VendorNumber long, ObservedLeadTimeDays int")
    schema = "TotalPurchaseDollars double, OTIFPct double, OnTimePct double, InFullPct double"
    good = spark.createDataFrame([(10.0, None, None, None)], schema)
    assert audit.assert_valid(audit.procurement_validation(po, good, 1, 4.0, 10.0))["purchase_spend_matches_validated"]
    with pytest.raises(quality.DataQualityError):
        audit.assert_valid(audit.procurement_validation(po, good, 2, 4.0, 10.0))
    filled = spark.createDataFrame([(10.0, 1.0, None, None)], schema)
    with pytest.raises(quality.DataQualityError):
        audit.assert_valid(audit.procurement_validation(po, filled))


def test_reference_totals(spark):
    """Published totals: 12 day counts give median 10, the deviation and both quartiles."""
    # Orders per observed lead-time day (3 to 14) of the published portfolio.
    orders_per_day = [12, 22, 45, 175, 494, 711, 944, 883, 811, 758, 463, 225]
    rows = [(1, d) for d, n in enumerate(orders_per_day, start=3) for _ in range(n)]
    stats = leadtime.portfolio_lead_times(
        spark.createDataFrame(rows, "VendorNumber long, ObservedLeadTimeDays int")
    ).first()
    assert stats.Orders == 5543 and stats.MedianDays == 10.0
    assert (stats.Q1Days, stats.Q3Days) == (8.0, 12.0)
    assert abs(stats.StdDays - 2.1291696542263194) < 1e-12


def test_aging_chart_fills_missing_buckets(spark):
    aging = spark.createDataFrame(
        [("8-15 days", 4795, 316729541.44, 10.469238790406674, 86.50550243550424), ("0-7 days", 748, 5171224.09, 6.49331550802139, 13.494497564495761)],
        "POCycleAgingBucket string, POCount long, PurchaseSpend double, AverageLeadTimeDays double, ShareOfObservedPOsPct double",
    )
    rows = charts.aging_buckets(aging).collect()
    assert [r.POCycleAgingBucket for r in rows] == list(exprs.AGING_LABELS)
    assert [r.POCount for r in rows] == [748, 4795, 0, 0, 0]
    assert rows[2].AverageLeadTimeDays is None

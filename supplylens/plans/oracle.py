"""Plain SQL for each registered query, written against the raw test tables.

The statements share common table expressions; ``statement`` prepends the ones a query
refers to, directly or through others. They are a second formulation of each result,
for comparison only, and run in any engine with decimals and window functions.
"""

from __future__ import annotations

import re


def r6(expression: str) -> str:
    """Six decimals, half up, by floor."""
    return f"floor(({expression}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE"


def fsum(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(28,10))) AS DOUBLE)"


def msum(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(28,4))) AS DOUBLE)"


def moments_std(n: str, s: str, q: str) -> str:
    return f"sqrt({moments_var(n, s, q)})"


def moments_var(n: str, s: str, q: str) -> str:
    return (
        f"CASE WHEN {n} > 1 THEN CAST({n} * {q} - {s} * {s} AS DOUBLE) "
        f"/ CAST({n} * ({n} - 1) AS DOUBLE) END"
    )


CTES: dict[str, str] = {}

# ---- source tables -------------------------------------------------------------------

CTES["nv"] = "SELECT max(s_suppkey) + 1 AS n FROM supplier"
CTES["li"] = """
SELECT l.*, CASE WHEN l_partkey % 4 = 0 THEN l_suppkey ELSE l_partkey % (SELECT n FROM nv) END AS v
FROM lineitem l"""
CTES["buy"] = """
SELECT concat_ws('_', o_custkey % 80 + 1, l_partkey, p_size) AS InventoryId,
    o_custkey % 80 + 1 AS Store, l_partkey AS Brand, p_name AS Description,
    CAST(p_size AS VARCHAR) || 'mL' AS Size, CAST(p_size % 2 + 1 AS BIGINT) AS Classification,
    v AS VendorNumber, l_orderkey AS PONumber,
    s_name || CASE WHEN v % 50 = 3 AND l_partkey % 2 = 0 THEN ' LLC' ELSE '' END
        || CASE WHEN l_orderkey % 7 = 0 THEN '  ' ELSE '' END AS VendorName,
    CAST(o_orderdate AS DATE)
        + CASE WHEN l_orderkey % 97 = 0 AND l_linenumber % 2 = 1 THEN 1 ELSE 0 END AS PODate,
    CASE WHEN l_orderkey % 53 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(
        3 + (l_orderkey * 7 + l_linenumber * 3) % 12
        + CASE WHEN l_orderkey % 41 = 0 THEN 60 WHEN l_orderkey % 29 = 0 THEN 20
               WHEN l_orderkey % 23 = 0 THEN 40 ELSE 0 END AS INTEGER) END AS ReceivingDate,
    CAST(o_orderdate AS DATE) + 20 AS InvoiceDate, CAST(o_orderdate AS DATE) + 50 AS PayDate,
    CAST(l_quantity AS BIGINT) AS Quantity, l_extendedprice AS Dollars,
    CASE WHEN l_partkey % 19 = 0 THEN 0.0::DOUBLE
         ELSE floor(l_extendedprice / l_quantity * 100 + 0.5) / 100.0::DOUBLE END AS PurchasePrice
FROM li JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = v"""
CTES["bill"] = """
SELECT g.v AS VendorNumber, s_name AS VendorName,
    g.o + CASE WHEN g.st = 'P' THEN 10000000 ELSE 0 END AS PONumber, g.od AS PODate,
    g.od + 20 AS InvoiceDate, g.od + 50 AS PayDate,
    CAST(g.q + CASE WHEN g.o % 31 = 0 THEN 1 WHEN g.o % 43 = 0 THEN -1 ELSE 0 END AS BIGINT) AS Quantity,
    g.d - CASE WHEN g.o % 37 = 0 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS Dollars,
    floor(g.d * 0.005::DOUBLE * 100 + 0.5) / 100.0::DOUBLE AS Freight, CAST(NULL AS VARCHAR) AS Approval
FROM (SELECT v, l_orderkey AS o, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS od,
        SUM(CAST(l_quantity AS BIGINT)) AS q,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,4))) AS DOUBLE) AS d
      FROM li JOIN orders ON o_orderkey = l_orderkey
      WHERE o_orderstatus IN ('F', 'O') OR l_orderkey % 5 = 0 GROUP BY ALL) g
JOIN supplier ON s_suppkey = g.v"""
CTES["sell"] = """
SELECT x.*, floor(SalesDollars / SalesQuantity * 100 + 0.5) / 100.0::DOUBLE AS SalesPrice,
    s_name AS VendorName
FROM (SELECT concat_ws('_', o_custkey % 80 + 1, l_partkey, p_size) AS InventoryId,
        CAST(p_size AS VARCHAR) || 'mL' AS Size, CAST(p_size * 10 AS DOUBLE) AS Volume,
        CAST(p_size % 2 + 1 AS BIGINT) AS Classification,
        l_partkey AS Brand, p_name AS Description, CAST(l_quantity AS BIGINT) AS SalesQuantity,
        o_custkey % 80 + 1 AS Store,
        CASE WHEN l_partkey % 11 = 0 THEN (v + 1) % (SELECT n FROM nv) ELSE v END AS VendorNo,
        floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100.0::DOUBLE AS SalesDollars,
        floor(l_extendedprice * l_tax * 100 + 0.5) / 100.0::DOUBLE AS ExciseTax,
        CAST(l_shipdate AS DATE) AS SalesDate
      FROM li JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
      WHERE l_returnflag <> 'R') x
JOIN supplier ON s_suppkey = VendorNo"""
CTES["quote"] = """
SELECT k.v AS VendorNumber, k.b AS Brand, p_name AS Description, p_retailprice + c.n AS Price,
    floor(p_retailprice * 0.75::DOUBLE * 100 + 0.5) / 100.0::DOUBLE + c.n * 0.5::DOUBLE AS PurchasePrice,
    CASE WHEN k.b % 13 = 0 THEN 'Unknown' ELSE CAST(p_size * 10 AS VARCHAR) END AS Volume,
    CAST(p_size AS VARCHAR) || 'mL' AS Size, CAST(p_size % 2 + 1 AS BIGINT) AS Classification,
    s_name AS VendorName
FROM (SELECT DISTINCT v, l_partkey AS b FROM li) k
JOIN (VALUES (0), (1)) c(n) ON c.n = 0 OR k.b % 23 = 0
JOIN part ON p_partkey = k.b JOIN supplier ON s_suppkey = k.v"""
CTES["places"] = """
SELECT DISTINCT o_custkey % 80 + 1 AS Store, l_partkey AS Brand
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
CTES["stock0"] = """
SELECT Store, Brand, 'CITY' || Store AS City, (Store * 13 + Brand * 7) % 50 AS onHand, p_retailprice AS Price,
    concat_ws('_', Store, Brand) AS InventoryId, p_name AS Description, CAST(p_size AS VARCHAR) || 'mL' AS Size,
    DATE '1996-01-01' AS startDate
FROM places JOIN part ON p_partkey = Brand WHERE NOT (Brand % 3 = 0 AND (Store + Brand) % 7 = 0)"""
CTES["stock1"] = """
SELECT Store, Brand, 'CITY' || Store AS City, (Store * 11 + Brand * 3) % 40 AS onHand, p_retailprice AS Price,
    concat_ws('_', Store, Brand) AS InventoryId, p_name AS Description, CAST(p_size AS VARCHAR) || 'mL' AS Size,
    DATE '1996-12-31' AS endDate
FROM places JOIN part ON p_partkey = Brand WHERE NOT (Brand % 5 = 0 AND (Store + Brand) % 6 = 0)"""

# ---- orders --------------------------------------------------------------------------

CTES["po_buy"] = """
SELECT VendorNumber, PONumber, max(trim(VendorName)) AS nm, min(PODate) AS po, max(PODate) AS po2,
    min(ReceivingDate) AS r1, max(ReceivingDate) AS r2, min(InvoiceDate) AS inv, min(PayDate) AS pay,
    CAST(SUM(Quantity) AS DOUBLE) AS q, CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS d, count(*) AS n
FROM buy GROUP BY 1, 2"""
CTES["po_bill"] = """
SELECT VendorNumber, PONumber, max(trim(VendorName)) AS nm, min(PODate) AS po, min(InvoiceDate) AS inv,
    min(PayDate) AS pay, CAST(SUM(Quantity) AS DOUBLE) AS q,
    CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS d,
    CAST(SUM(CAST(Freight AS DECIMAL(28,4))) AS DOUBLE) AS f
FROM bill GROUP BY 1, 2"""
CTES["po"] = """
SELECT VendorNumber, PONumber, coalesce(b.nm, i.nm) AS VendorName, coalesce(b.po, i.po) AS PODate,
    b.r1 AS FirstReceivingDate, b.r2 AS LastReceivingDate, coalesce(b.inv, i.inv) AS InvoiceDate,
    coalesce(b.pay, i.pay) AS PayDate, b.q AS PurchaseQuantity, b.d AS PurchaseDollars,
    b.n AS PurchaseLineCount,
    CAST(CASE WHEN b.po = b.po2 THEN b.r2 - b.po END AS INTEGER) AS ObservedLeadTimeDays,
    i.q AS InvoiceQuantity, i.d AS InvoiceDollars, i.f AS Freight,
    CASE WHEN b.n IS NULL THEN 'Invoice only' WHEN i.q IS NULL THEN 'Purchase only'
         ELSE 'Matched' END AS PurchaseOrderMatchStatus,
    i.q - b.q AS InvoiceQuantityVariance,
    CAST(CAST(i.d AS DECIMAL(28,4)) - CAST(b.d AS DECIMAL(28,4)) AS DOUBLE) AS InvoiceDollarsVariance
FROM po_buy b FULL JOIN po_bill i USING (VendorNumber, PONumber)"""
CTES["pox"] = """
SELECT *, CASE WHEN ObservedLeadTimeDays < 0 THEN NULL WHEN ObservedLeadTimeDays <= 7 THEN '0-7 days'
        WHEN ObservedLeadTimeDays <= 15 THEN '8-15 days' WHEN ObservedLeadTimeDays <= 30 THEN '16-30 days'
        WHEN ObservedLeadTimeDays <= 60 THEN '31-60 days' WHEN ObservedLeadTimeDays > 60 THEN '60+ days'
        END AS POCycleAgingBucket,
    CAST(InvoiceDate - PODate AS INTEGER) AS POToInvoiceDays,
    CAST(InvoiceDate - LastReceivingDate AS INTEGER) AS ReceiptToInvoiceDays,
    CASE PurchaseOrderMatchStatus WHEN 'Matched' THEN 1 ELSE 0 END AS HasInvoiceMatch,
    CASE WHEN PurchaseOrderMatchStatus <> 'Matched' THEN 'Not matched'
        WHEN InvoiceQuantityVariance IS NULL THEN 'Unknown'
        WHEN abs(InvoiceQuantityVariance) < 1e-9 THEN 'Quantity aligned'
        WHEN InvoiceQuantityVariance < 0 THEN 'Invoice qty below purchase qty'
        ELSE 'Invoice qty above purchase qty' END AS QuantityReconciliationFlag,
    CASE WHEN PurchaseOrderMatchStatus <> 'Matched' THEN 'Not matched'
        WHEN InvoiceDollarsVariance IS NULL THEN 'Unknown'
        WHEN abs(InvoiceDollarsVariance) < 0.01::DOUBLE THEN 'Dollars aligned'
        WHEN InvoiceDollarsVariance < 0 THEN 'Invoice dollars below purchase dollars'
        ELSE 'Invoice dollars above purchase dollars' END AS DollarReconciliationFlag,
    'Observed lead time + invoice reconciliation (true OTIF unsupported: no promised date / ordered qty)'
        AS DeliveryMetricBasis
FROM po"""
CTES["deliv"] = """
SELECT VendorNumber, VendorName, count(PONumber) AS PurchaseOrderKeyCount,
    count(PurchaseQuantity) AS PurchaseSidePOCount,
    count(*) FILTER (PurchaseOrderMatchStatus = 'Matched') AS MatchedPOCount,
    count(*) FILTER (PurchaseOrderMatchStatus = 'Purchase only') AS PurchaseOnlyPOCount,
    count(*) FILTER (PurchaseOrderMatchStatus = 'Invoice only') AS InvoiceOnlyPOCount,
    coalesce(CAST(SUM(CAST(PurchaseDollars AS DECIMAL(28,4))) AS DOUBLE), 0) AS PurchaseSpend,
    coalesce(CAST(SUM(CAST(InvoiceDollars AS DECIMAL(28,4))) AS DOUBLE), 0) AS InvoiceSpend,
    coalesce(CAST(SUM(CAST(Freight AS DECIMAL(28,4))) AS DOUBLE), 0) AS FreightSpend,
    count(*) FILTER (QuantityReconciliationFlag = 'Quantity aligned') AS QuantityAlignedPOCount,
    count(*) FILTER (QuantityReconciliationFlag LIKE 'Invoice qty%') AS QuantityDiscrepancyPOCount,
    count(*) FILTER (DollarReconciliationFlag = 'Dollars aligned') AS DollarAlignedPOCount,
    count(*) FILTER (DollarReconciliationFlag LIKE 'Invoice dollars%') AS DollarDiscrepancyPOCount,
    CASE WHEN PurchaseOrderKeyCount > 0 THEN MatchedPOCount / PurchaseOrderKeyCount * 100 END AS InvoiceMatchRatePct,
    CASE WHEN MatchedPOCount > 0 THEN QuantityAlignedPOCount / MatchedPOCount * 100 END AS QuantityAlignmentRatePct,
    CASE WHEN MatchedPOCount > 0 THEN DollarAlignedPOCount / MatchedPOCount * 100 END AS DollarAlignmentRatePct,
    false AS OTIFSupported, 'Invoice reconciliation performance (not OTIF)' AS DeliveryMetricLabel
FROM pox GROUP BY VendorNumber, VendorName"""
CTES["aging"] = """
SELECT POCycleAgingBucket, count(PONumber) AS POCount,
    coalesce(CAST(SUM(CAST(PurchaseDollars AS DECIMAL(28,4))) AS DOUBLE), 0) AS PurchaseSpend,
    CAST(SUM(ObservedLeadTimeDays) AS DOUBLE) / count(*) AS AverageLeadTimeDays,
    POCount / CAST(SUM(POCount) OVER () AS DOUBLE) * 100 AS ShareOfObservedPOsPct,
    'Observed PO cycle time = LastReceivingDate - PODate (completed receipts only; not open-order aging)' AS AgingBasis
FROM pox WHERE ObservedLeadTimeDays IS NOT NULL GROUP BY POCycleAgingBucket"""

# ---- inventory -----------------------------------------------------------------------

CTES["pos"] = """
SELECT Store, Brand, b.u AS BeginningUnits, e.u AS EndingUnits, b.w AS BeginningRetailValue,
    e.w AS EndingRetailValue, (b.u + e.u) / 2.0::DOUBLE AS AverageInventoryUnits,
    CASE WHEN b.u > 0 THEN 1 WHEN b.u IS NOT NULL THEN 0 END AS BeginningAvailable,
    CASE WHEN e.u > 0 THEN 1 WHEN e.u IS NOT NULL THEN 0 END AS EndingAvailable,
    CASE WHEN b.u + e.u IS NOT NULL THEN 1 ELSE 0 END AS HasBothSnapshots
FROM (SELECT Store, Brand, CAST(SUM(onHand) AS DOUBLE) AS u,
        CAST(SUM(onHand * CAST(Price AS DECIMAL(18,4))) AS DOUBLE) AS w FROM stock0 GROUP BY 1, 2) b
FULL JOIN (SELECT Store, Brand, CAST(SUM(onHand) AS DOUBLE) AS u,
        CAST(SUM(onHand * CAST(Price AS DECIMAL(18,4))) AS DOUBLE) AS w FROM stock1 GROUP BY 1, 2) e
USING (Store, Brand)"""
CTES["posx"] = """
SELECT *, CASE WHEN EndingUnits <= 0 THEN 1 WHEN EndingUnits > 0 THEN 0 END AS LowInventoryFlag,
    EndingUnits - BeginningUnits AS InventoryMovementUnits FROM pos"""
CTES["brand_stock"] = """
SELECT Brand, count(*) AS StoreCount, count(*) FILTER (HasBothSnapshots = 1) AS CompleteStoreCount,
    SUM(AverageInventoryUnits) FILTER (HasBothSnapshots = 1) AS AverageInventoryUnits,
    SUM(EndingUnits) FILTER (HasBothSnapshots = 1) AS EndingInventoryUnits,
    CAST(SUM(CAST(EndingRetailValue AS DECIMAL(28,4))) FILTER (HasBothSnapshots = 1) AS DOUBLE)
        AS EndingInventoryRetailValue
FROM pos GROUP BY Brand"""

# ---- vendor-brand summary ------------------------------------------------------------

CTES["vb_buy"] = """
SELECT VendorNumber, Brand, max(trim(VendorName)) AS VendorName, max(trim(Description)) AS Description,
    CAST(SUM(Quantity) AS DOUBLE) AS TotalPurchaseQuantity,
    CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS TotalPurchaseDollars,
    CAST(SUM(Quantity * CAST(PurchasePrice AS DECIMAL(18,4))) FILTER (PurchasePrice > 0 AND Quantity > 0) AS DOUBLE)
        / CAST(SUM(Quantity) FILTER (PurchasePrice > 0 AND Quantity > 0) AS DOUBLE) AS PurchasePrice,
    CAST(SUM(Quantity) FILTER (PurchasePrice > 0 AND Quantity > 0) AS DOUBLE) AS CostCoveredPurchaseQuantity
FROM buy GROUP BY 1, 2"""
CTES["vb_sell"] = """
SELECT VendorNo, Brand, max(trim(VendorName)) AS VendorName, max(trim(Description)) AS Description,
    CAST(SUM(CAST(SalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS TotalSalesDollars,
    CAST(SUM(SalesQuantity) AS DOUBLE) AS TotalSalesQuantity,
    CAST(SUM(CAST(ExciseTax AS DECIMAL(28,4))) AS DOUBLE) AS TotalExciseTax,
    CAST(SUM(CAST(SalesPrice AS DECIMAL(18,4)) * SalesQuantity) AS DOUBLE)
        / CAST(SUM(SalesQuantity) AS DOUBLE) AS TotalSalesPrice
FROM sell GROUP BY 1, 2"""
CTES["vb_price"] = """
SELECT VendorNumber, Brand, CASE WHEN count(DISTINCT Price) = 1 THEN max(Price) END AS ActualPrice,
    CASE WHEN count(DISTINCT PurchasePrice) = 1 THEN max(PurchasePrice) END AS ReferencePurchasePrice,
    max(TRY_CAST(Volume AS DOUBLE)) AS Volume
FROM quote GROUP BY 1, 2"""
CTES["vend_money"] = """
SELECT VendorNumber, d AS VendorPurchaseDollars, f AS VendorFreight
FROM (SELECT VendorNumber, CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) AS d
      FROM vb_buy GROUP BY 1) LEFT JOIN
     (SELECT VendorNumber, CAST(SUM(CAST(Freight AS DECIMAL(28,4))) AS DOUBLE) AS f FROM bill GROUP BY 1)
USING (VendorNumber)"""
CTES["brand_ok"] = """
SELECT Brand, s.AverageInventoryUnits AS a, s.EndingInventoryUnits AS e, s.EndingInventoryRetailValue AS w
FROM brand_stock s JOIN (SELECT Brand FROM vb_buy GROUP BY 1 HAVING count(*) = 1) USING (Brand)
WHERE StoreCount = CompleteStoreCount"""
CTES["vb0"] = """
SELECT VendorNumber, coalesce(p.VendorName, s.VendorName) AS VendorName, Brand,
    coalesce(p.Description, s.Description) AS Description, p.PurchasePrice, r.ActualPrice, r.Volume,
    coalesce(p.TotalPurchaseQuantity, 0) AS TotalPurchaseQuantity, p.CostCoveredPurchaseQuantity,
    coalesce(p.TotalPurchaseDollars, 0) AS TotalPurchaseDollars,
    coalesce(s.TotalSalesDollars, 0) AS TotalSalesDollars, s.TotalSalesPrice,
    coalesce(s.TotalSalesQuantity, 0) AS TotalSalesQuantity, coalesce(s.TotalExciseTax, 0) AS TotalExciseTax,
    CASE WHEN m.VendorPurchaseDollars > 0
        THEN m.VendorFreight * p.TotalPurchaseDollars / m.VendorPurchaseDollars END AS FreightCost,
    r.ReferencePurchasePrice, p.PurchasePrice - r.ReferencePurchasePrice AS PurchasePriceVariance,
    o.a AS AverageInventoryUnits, o.e AS EndingInventoryUnits, o.w AS EndingInventoryRetailValue,
    CASE WHEN o.a > 0 THEN s.TotalSalesQuantity / o.a END AS StockTurnover,
    o.e * p.PurchasePrice AS "Unsold Capital",
    CASE WHEN p.PurchasePrice IS NOT NULL AND p.TotalPurchaseQuantity > 0 AND s.TotalSalesQuantity > 0
        THEN s.TotalSalesDollars END AS CostCoveredSalesDollars,
    CASE WHEN p.PurchasePrice IS NULL OR p.TotalPurchaseQuantity <= 0 OR s.TotalSalesQuantity <= 0
        THEN coalesce(s.TotalSalesDollars, 0) ELSE 0.0::DOUBLE END AS UncostedSalesDollars
FROM vb_buy p FULL JOIN (SELECT VendorNo AS VendorNumber, * EXCLUDE (VendorNo) FROM vb_sell) s
    USING (VendorNumber, Brand)
LEFT JOIN vb_price r USING (VendorNumber, Brand) LEFT JOIN vend_money m USING (VendorNumber)
LEFT JOIN brand_ok o ON o.Brand = p.Brand"""
CTES["vb"] = """
SELECT *, CASE WHEN CostCoveredSalesDollars > 0 THEN GrossProfit / CostCoveredSalesDollars * 100 END AS ProfitMargin,
    CASE WHEN TotalPurchaseDollars > 0 THEN TotalSalesDollars / TotalPurchaseDollars END AS SalesToPurchaseRatio,
    CASE WHEN ReferencePurchasePrice > 0 THEN PurchasePriceVariance / ReferencePurchasePrice * 100 END
        AS PurchasePriceVariancePct
FROM (SELECT *, CASE WHEN PurchasePrice IS NOT NULL AND CostCoveredPurchaseQuantity > 0 AND TotalSalesQuantity > 0
        THEN TotalSalesDollars - TotalSalesQuantity * PurchasePrice END AS GrossProfit FROM vb0)"""
CTES["good"] = "SELECT * FROM vb WHERE ProfitMargin > 0 AND GrossProfit > 0 AND TotalSalesQuantity > 0"

# ---- vendors -------------------------------------------------------------------------

CTES["vend0"] = f"""
SELECT VendorNumber, VendorName, {msum('TotalPurchaseQuantity')} AS TotalPurchaseQuantity,
    coalesce({msum('CostCoveredPurchaseQuantity')}, 0) AS CostCoveredPurchaseQuantity,
    {msum('TotalPurchaseDollars')} AS TotalPurchaseDollars, {msum('TotalSalesQuantity')} AS TotalSalesQuantity,
    {msum('TotalSalesDollars')} AS TotalSalesDollars, {msum('CostCoveredSalesDollars')} AS CostCoveredSalesDollars,
    {msum('UncostedSalesDollars')} AS UncostedSalesDollars,
    coalesce({fsum('PurchasePrice * CostCoveredPurchaseQuantity')}, 0) AS WeightedPurchaseCost,
    {fsum('GrossProfit')} AS EstimatedGrossProfit, {fsum('FreightCost')} AS AllocatedFreight
FROM vb GROUP BY 1, 2"""
CTES["vend_stock"] = f"""
SELECT VendorNumber, VendorName, count(DISTINCT Brand) AS EligibleInventoryBrandCount,
    {msum('TotalSalesQuantity')} AS EligibleSalesUnits, {fsum('AverageInventoryUnits')} AS EligibleAverageInventoryUnits,
    {fsum('EndingInventoryUnits')} AS EligibleEndingInventoryUnits,
    {fsum('"Unsold Capital"')} AS EstimatedEndingInventoryCost
FROM vb WHERE StockTurnover IS NOT NULL GROUP BY 1, 2"""
CTES["vend"] = """
SELECT v.*, CASE WHEN CostCoveredPurchaseQuantity > 0 THEN WeightedPurchaseCost / CostCoveredPurchaseQuantity END
        AS WeightedPurchasePrice,
    CASE WHEN CostCoveredSalesDollars > 0 THEN EstimatedGrossProfit / CostCoveredSalesDollars * 100 END
        AS EstimatedProfitMarginPct,
    CASE WHEN TotalPurchaseDollars > 0 THEN TotalSalesDollars / TotalPurchaseDollars END AS SalesToPurchaseRatio,
    CASE WHEN TotalPurchaseDollars > 0 THEN AllocatedFreight / TotalPurchaseDollars END AS FreightPerPurchaseDollar,
    CASE WHEN TotalPurchaseDollars > 0 THEN TotalPurchaseDollars / t.spend * 100 END AS PurchaseContributionPct,
    CASE WHEN t.sales > 0 THEN TotalSalesDollars / t.sales * 100 END AS SalesContributionPct,
    rank() OVER (ORDER BY TotalPurchaseDollars DESC) AS VendorSpendRank,
    CAST(SUM(CASE WHEN TotalPurchaseDollars > 0 THEN CAST(TotalPurchaseDollars AS DECIMAL(28,4)) ELSE 0 END) OVER (
        ORDER BY TotalPurchaseDollars DESC, VendorNumber, VendorName ROWS UNBOUNDED PRECEDING) AS DOUBLE)
        / t.spend * 100 AS CumulativePurchaseContributionPct,
    EligibleInventoryBrandCount, EligibleSalesUnits, EligibleAverageInventoryUnits, EligibleEndingInventoryUnits,
    EstimatedEndingInventoryCost,
    CASE WHEN EligibleAverageInventoryUnits > 0 THEN EligibleSalesUnits / EligibleAverageInventoryUnits END
        AS EligibleInventoryTurnover
FROM vend0 v LEFT JOIN vend_stock USING (VendorNumber, VendorName), (
    SELECT CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) FILTER (TotalPurchaseDollars > 0) AS DOUBLE) AS spend,
        CAST(SUM(CAST(TotalSalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS sales FROM vend0) t"""
CTES["vend_top"] = """
SELECT VendorNumber FROM vend0 WHERE TotalPurchaseDollars > 0
ORDER BY TotalPurchaseDollars DESC, VendorNumber, VendorName LIMIT 10"""
CTES["cats"] = """
SELECT CASE WHEN VendorNumber IN (SELECT VendorNumber FROM vend_top) THEN VendorName ELSE 'Others' END AS c,
    SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS d
FROM vend0 WHERE TotalPurchaseDollars > 0 GROUP BY 1"""
CTES["vend_cat"] = """
SELECT c AS "Vendor Category", CAST(d AS DOUBLE) AS TotalPurchaseDollars,
    CASE WHEN c = (SELECT c FROM cats ORDER BY d DESC, c LIMIT 1) THEN
        (SELECT CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4)))
                    FILTER (VendorNumber IN (SELECT VendorNumber FROM vend_top)) AS DOUBLE)
            / CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) * 100
         FROM vend0 WHERE TotalPurchaseDollars > 0) ELSE 0.0::DOUBLE END AS Top10Cont
FROM cats"""
CTES["turn"] = f"""
SELECT VendorNumber, VendorName, {msum('TotalSalesQuantity')} / {fsum('AverageInventoryUnits')} AS AvgStockTurnOver
FROM vb WHERE StockTurnover IS NOT NULL GROUP BY 1, 2"""
CTES["brands"] = f"""
SELECT Brand, Description, {msum('TotalSalesDollars')} AS TotalSales,
    CASE WHEN {msum('CostCoveredSalesDollars')} > 0
        THEN {fsum('GrossProfit')} / {msum('CostCoveredSalesDollars')} * 100 END AS AvgProfitMargin
FROM vb GROUP BY 1, 2"""
CTES["brand_perf"] = """
SELECT Brand, Description, TotalSales, AvgProfitMargin,
    coalesce(TotalSales <= (SELECT quantile_cont(TotalSales, 0.15) FROM brands WHERE TotalSales > 0)
        AND AvgProfitMargin >= (SELECT quantile_cont(AvgProfitMargin, 0.85) FROM brands), false) AS TargetBrand
FROM brands"""

# ---- lead times ----------------------------------------------------------------------

CTES["lead_all"] = f"""
SELECT n AS Orders, CAST(s AS DOUBLE) / n AS MeanDays, q1 AS Q1Days, md AS MedianDays, q3 AS Q3Days,
    {moments_std('n', 's', 'q')} AS StdDays
FROM (SELECT count(*) AS n, SUM(x) AS s, SUM(CAST(x AS BIGINT) * x) AS q, quantile_cont(CAST(x AS DOUBLE), 0.25) AS q1,
        quantile_cont(CAST(x AS DOUBLE), 0.5) AS md, quantile_cont(CAST(x AS DOUBLE), 0.75) AS q3
      FROM (SELECT ObservedLeadTimeDays AS x FROM pox WHERE ObservedLeadTimeDays IS NOT NULL))"""
CTES["lead"] = """
SELECT VendorNumber, VendorName, PONumber, PODate, LastReceivingDate, ObservedLeadTimeDays, PurchaseDollars,
    POCycleAgingBucket,
    CASE WHEN ObservedLeadTimeDays < Q1Days - (Q3Days - Q1Days) * 1.5::DOUBLE
        OR ObservedLeadTimeDays > Q3Days + (Q3Days - Q1Days) * 1.5::DOUBLE THEN 1 ELSE 0 END AS LeadTimeOutlierFlag,
    MedianDays AS PortfolioMedianLeadTimeDays, MeanDays AS PortfolioMeanLeadTimeDays,
    StdDays AS PortfolioStdLeadTimeDays, ObservedLeadTimeDays - MedianDays AS LeadTimeVsMedianDays
FROM pox, lead_all WHERE ObservedLeadTimeDays IS NOT NULL"""
CTES["lead_sup"] = f"""
SELECT VendorNumber, VendorName, c AS ObservedLeadTimeOrderCount, CAST(s AS DOUBLE) / n AS AverageLeadTimeDays,
    md AS MedianLeadTimeDays, lo AS MinLeadTimeDays, hi AS MaxLeadTimeDays,
    {moments_std('n', 's', 'q')} AS LeadTimeStdDevDays, {moments_var('n', 's', 'q')} AS LeadTimeVarianceDays,
    o AS OutlierLeadTimeOrderCount, d AS LeadTimePurchaseSpend,
    1 / (1 + coalesce({moments_std('n', 's', 'q')}, 0.0::DOUBLE)) AS LeadTimeConsistencyScore
FROM (SELECT VendorNumber, VendorName, count(DISTINCT PONumber) AS c, count(*) AS n, SUM(ObservedLeadTimeDays) AS s,
        SUM(CAST(ObservedLeadTimeDays AS BIGINT) * ObservedLeadTimeDays) AS q,
        quantile_cont(CAST(ObservedLeadTimeDays AS DOUBLE), 0.5) AS md,
        CAST(min(ObservedLeadTimeDays) AS DOUBLE) AS lo, CAST(max(ObservedLeadTimeDays) AS DOUBLE) AS hi,
        CAST(SUM(LeadTimeOutlierFlag) AS BIGINT) AS o,
        CAST(SUM(CAST(PurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) AS d FROM lead GROUP BY 1, 2)"""
CTES["lead_brand"] = f"""
SELECT Brand, Description, c AS ObservedLeadTimeOrderCount, CAST(s AS DOUBLE) / n AS AverageLeadTimeDays,
    md AS MedianLeadTimeDays, {moments_std('n', 's', 'q')} AS LeadTimeStdDevDays,
    {moments_var('n', 's', 'q')} AS LeadTimeVarianceDays, vc AS PurchasingVendorCount
FROM (SELECT Brand, Description, count(DISTINCT PONumber) AS c, count(*) AS n, SUM(x) AS s, SUM(CAST(x AS BIGINT) * x) AS q,
        quantile_cont(CAST(x AS DOUBLE), 0.5) AS md, count(DISTINCT VendorNumber) AS vc
      FROM (SELECT Brand, max(trim(Description)) AS Description, VendorNumber, PONumber
            FROM buy GROUP BY Brand, VendorNumber, PONumber)
      JOIN (SELECT VendorNumber, PONumber, ObservedLeadTimeDays AS x FROM pox
            WHERE ObservedLeadTimeDays IS NOT NULL) USING (VendorNumber, PONumber) GROUP BY 1, 2)"""

# ---- scorecard and risk --------------------------------------------------------------

CTES["price_var"] = f"""
SELECT VendorNumber, VendorName, count(ReferencePurchasePrice) AS BrandsWithReferencePrice,
    {fsum('PurchasePriceVariancePct')} / count(PurchasePriceVariancePct) AS AveragePurchasePriceVariancePct,
    {fsum('abs(PurchasePriceVariancePct)')} / count(PurchasePriceVariancePct) AS AbsoluteAvgPriceVariancePct
FROM vb GROUP BY 1, 2"""
CTES["card0"] = """
SELECT * EXCLUDE (OTIFSupported) FROM vend LEFT JOIN lead_sup USING (VendorNumber, VendorName)
LEFT JOIN deliv USING (VendorNumber, VendorName) LEFT JOIN price_var USING (VendorNumber, VendorName)"""


def _rank(column: str, higher: bool) -> str:
    place = f"rank() OVER (ORDER BY {column} NULLS LAST)"
    ties = f"count(*) OVER (PARTITION BY {column})"
    share = f"({place} - 1 + ({ties} + 1) / 2.0::DOUBLE) / count({column}) OVER ()"
    share = share if higher else f"1.0::DOUBLE - {share}"
    return f"CASE WHEN {column} IS NOT NULL THEN {share} END"


CTES["card_ranks"] = f"""
SELECT VendorNumber, VendorName, ObservedLeadTimeOrderCount,
    {_rank('LeadTimeConsistencyScore', True)} AS k1, {_rank('InvoiceMatchRatePct', True)} AS k2,
    {_rank('QuantityAlignmentRatePct', True)} AS k3,
    {_rank('AbsoluteAvgPriceVariancePct', False)} AS k4, {_rank('MedianLeadTimeDays', False)} AS k5
FROM card0"""
CTES["card_score"] = """
SELECT VendorNumber, VendorName, CASE WHEN ObservedLeadTimeOrderCount >= 5 THEN
    (coalesce(k1, 0) + coalesce(k2, 0) + coalesce(k3, 0) + coalesce(k4, 0) + coalesce(k5, 0))
    / nullif((k1 IS NOT NULL)::INT + (k2 IS NOT NULL)::INT + (k3 IS NOT NULL)::INT + (k4 IS NOT NULL)::INT
        + (k5 IS NOT NULL)::INT, 0) * 100 END AS SupplierPerformanceScore
FROM card_ranks"""
CTES["card"] = """
SELECT card0.*, SupplierPerformanceScore,
    CASE WHEN SupplierPerformanceScore IS NULL THEN 'Insufficient data'
        WHEN SupplierPerformanceScore >= a THEN 'High Performing'
        WHEN SupplierPerformanceScore >= b THEN 'Stable / Acceptable'
        WHEN SupplierPerformanceScore >= c THEN 'Watchlist' ELSE 'Underperforming' END AS PerformanceStatus,
    a AS ScoreThresholdP75, b AS ScoreThresholdP25, c AS ScoreThresholdP10,
    CAST(NULL AS DOUBLE) AS OTIFPct, CAST(NULL AS DOUBLE) AS OnTimePct, CAST(NULL AS DOUBLE) AS InFullPct,
    false AS OTIFSupported,
    'Source data has no promised delivery date and no distinct ordered quantity; OTIF/On-Time/In-Full cannot be calculated. Use InvoiceMatchRatePct and QuantityAlignmentRatePct as delivery-reconciliation proxies.'
        AS OTIFLimitationNote
FROM card0 JOIN card_score USING (VendorNumber, VendorName), (
    SELECT quantile_cont(SupplierPerformanceScore, 0.75) AS a, quantile_cont(SupplierPerformanceScore, 0.25) AS b,
        quantile_cont(SupplierPerformanceScore, 0.1) AS c FROM card_score)"""
CTES["slow_po"] = """
SELECT VendorNumber, count(*) AS n FROM pox, lead_all WHERE ObservedLeadTimeDays >= Q3Days GROUP BY 1"""
CTES["risk"] = """
SELECT *, CASE WHEN PerformanceStatus IN ('Underperforming', 'Watchlist') OR RiskFlagCount >= 3
        OR (HighSpendConcentrationFlag = 1 AND RiskFlagCount >= 2) THEN 'Prioritize procurement review'
        WHEN RiskFlagCount >= 1 THEN 'Monitor' ELSE 'Maintain' END AS RecommendedAttention
FROM (SELECT *, HighLeadTimeRisk + LeadTimeConsistencyRisk + DeliveryReconciliationRisk + PriceVarianceRisk
        + InventoryExposureRisk + POAgingRisk AS RiskFlagCount
    FROM (SELECT VendorNumber, VendorName, TotalPurchaseDollars, PurchaseContributionPct, MedianLeadTimeDays,
            LeadTimeStdDevDays, LeadTimeVarianceDays, InvoiceMatchRatePct, QuantityAlignmentRatePct,
            AbsoluteAvgPriceVariancePct, EligibleInventoryTurnover, EstimatedEndingInventoryCost,
            SupplierPerformanceScore, PerformanceStatus, ObservedLeadTimeOrderCount, MatchedPOCount,
            PurchaseOrderKeyCount,
            CASE WHEN MedianLeadTimeDays > Q3Days THEN 1 ELSE 0 END AS HighLeadTimeRisk,
            CASE WHEN LeadTimeStdDevDays > StdDays THEN 1 ELSE 0 END AS LeadTimeConsistencyRisk,
            CASE WHEN InvoiceMatchRatePct < 70 THEN 1 ELSE 0 END AS DeliveryReconciliationRisk,
            CASE WHEN AbsoluteAvgPriceVariancePct > pm THEN 1 ELSE 0 END AS PriceVarianceRisk,
            CASE WHEN PurchaseContributionPct >= 5 THEN 1 ELSE 0 END AS HighSpendConcentrationFlag,
            CASE WHEN EstimatedEndingInventoryCost > im THEN 1 ELSE 0 END AS InventoryExposureRisk,
            coalesce(n, 0) AS HighCycleTimePOCount, CASE WHEN n > 0 THEN 1 ELSE 0 END AS POAgingRisk,
            TotalPurchaseDollars / ts * 100 AS SupplierConcentrationPct,
            MedianDays AS PortfolioMedianLeadTimeDays
        FROM card LEFT JOIN slow_po USING (VendorNumber), lead_all, (
            SELECT median(AbsoluteAvgPriceVariancePct) AS pm, median(EstimatedEndingInventoryCost) AS im,
                CAST(SUM(CAST(TotalPurchaseDollars AS DECIMAL(28,4))) AS DOUBLE) AS ts FROM card)))"""

# ---- dimensions and monthly fact -----------------------------------------------------

CTES["d_supplier"] = """
SELECT VendorNumber, max(trim(VendorName)) AS VendorName, count(DISTINCT Brand) AS BrandCount,
    count(DISTINCT PONumber) AS PurchaseOrderCount, CAST(SUM(Quantity) AS DOUBLE) AS PurchaseQuantity,
    CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS PurchaseSpend FROM buy GROUP BY 1"""
CTES["d_brand"] = """
SELECT Brand, max(trim(Description)) AS Description, max(trim(Size)) AS Size, max(Classification) AS Classification,
    count(DISTINCT VendorNumber) AS PurchasingVendorCount FROM buy GROUP BY 1"""
CTES["d_store"] = """
SELECT Store, max(trim(City)) AS City FROM (SELECT Store, City FROM stock0 UNION ALL
    SELECT Store, City FROM stock1 UNION ALL SELECT Store, NULL FROM buy) GROUP BY 1"""
CTES["d_date"] = """
SELECT CAST(d AS DATE) AS FullDate, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey,
    CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month, strftime(d, '%b') AS MonthName,
    strftime(d, '%Y-%m') AS YearMonth, CAST(quarter(d) AS INTEGER) AS Quarter
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (
    SELECT min(x) AS lo, max(x) AS hi FROM (SELECT PODate AS x FROM buy UNION ALL
        SELECT ReceivingDate FROM buy UNION ALL SELECT SalesDate FROM sell UNION ALL
        SELECT InvoiceDate FROM bill)))"""
CTES["monthly"] = f"""
SELECT VendorNumber, max(trim(VendorName)) AS VendorName, Brand, max(trim(Description)) AS Description,
    CAST(date_trunc('month', PODate) AS DATE) AS SpendMonth, count(DISTINCT PONumber) AS PurchaseOrderCount,
    CAST(SUM(Quantity) AS DOUBLE) AS PurchaseQuantity,
    CAST(SUM(CAST(Dollars AS DECIMAL(28,4))) AS DOUBLE) AS PurchaseSpend,
    {fsum('PurchasePrice')} / count(PurchasePrice) AS AveragePurchasePrice
FROM buy WHERE PODate IS NOT NULL GROUP BY VendorNumber, Brand, 5"""

# ---- chart tables --------------------------------------------------------------------

CTES["c_monthly"] = """
SELECT strftime(SpendMonth, '%Y-%m') AS YearMonth,
    CAST(SUM(CAST(PurchaseSpend AS DECIMAL(28,4))) AS DOUBLE) AS PurchaseSpend,
    SUM(PurchaseQuantity) AS PurchaseQuantity FROM monthly GROUP BY 1"""
CTES["c_suppliers"] = """
SELECT VendorNumber, VendorName, TotalPurchaseDollars, TotalPurchaseQuantity, PurchaseContributionPct,
    MedianLeadTimeDays, AverageLeadTimeDays, LeadTimeStdDevDays, InvoiceMatchRatePct, QuantityAlignmentRatePct,
    DollarAlignmentRatePct, AbsoluteAvgPriceVariancePct, EstimatedEndingInventoryCost, PerformanceStatus,
    PurchaseOrderKeyCount, MatchedPOCount, SupplierPerformanceScore
FROM card ORDER BY TotalPurchaseDollars DESC, VendorNumber, VendorName LIMIT 20"""
CTES["c_brands"] = """
SELECT Brand, Description AS BrandName, CAST(SUM(CAST(PurchaseSpend AS DECIMAL(28,4))) AS DOUBLE) AS PurchaseSpend
FROM monthly GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 25"""
CTES["c_hist"] = """
SELECT ObservedLeadTimeDays AS LeadTimeDays, count(*) AS POCount FROM lead GROUP BY 1"""
CTES["c_trend"] = """
SELECT strftime(PODate, '%Y-%m') AS YearMonth, CAST(SUM(ObservedLeadTimeDays) AS DOUBLE) / count(*) AS AvgLeadTimeDays,
    quantile_cont(CAST(ObservedLeadTimeDays AS DOUBLE), 0.5) AS MedianLeadTimeDays, count(*) AS POCount
FROM lead WHERE PODate IS NOT NULL GROUP BY 1"""
CTES["c_aging"] = """
SELECT b AS POCycleAgingBucket, coalesce(POCount, 0) AS POCount, coalesce(PurchaseSpend, 0) AS PurchaseSpend,
    coalesce(ShareOfObservedPOsPct, 0) AS ShareOfObservedPOsPct, AverageLeadTimeDays
FROM (VALUES ('0-7 days'), ('8-15 days'), ('16-30 days'), ('31-60 days'), ('60+ days')) t(b)
LEFT JOIN aging ON POCycleAgingBucket = b"""
CTES["c_match"] = "SELECT PurchaseOrderMatchStatus, count(*) AS POCount FROM pox GROUP BY 1"
CTES["c_keys"] = """
SELECT * FROM (SELECT CAST(count(PurchaseQuantity) AS DOUBLE) AS PurchaseSidePOKeys,
    CAST(count(ObservedLeadTimeDays) AS DOUBLE) AS ObservedLeadTimeOrders,
    CAST(count(*) AS DOUBLE) AS ReconciliationKeysFullOuter,
    CAST(count(*) FILTER (PurchaseOrderMatchStatus = 'Matched') AS DOUBLE) AS MatchedPOKeys,
    CAST(count(*) FILTER (PurchaseOrderMatchStatus = 'Purchase only') AS DOUBLE) AS PurchaseOnlyKeys,
    CAST(count(*) FILTER (PurchaseOrderMatchStatus = 'Invoice only') AS DOUBLE) AS InvoiceOnlyKeys
    FROM pox) UNPIVOT (Value FOR Metric IN (COLUMNS(*)))"""
CTES["c_stores"] = """
SELECT Store, SUM(BeginningUnits) AS BeginningUnits, SUM(EndingUnits) AS EndingUnits,
    CAST(SUM(CAST(EndingRetailValue AS DECIMAL(28,4))) AS DOUBLE) AS EndingRetailValue,
    CAST(SUM(LowInventoryFlag) AS DOUBLE) AS LowInventoryFlag
FROM posx GROUP BY 1 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 30"""
CTES["c_stock"] = """
SELECT Brand, coalesce(SUM(BeginningUnits), 0) AS BeginningUnits, coalesce(SUM(EndingUnits), 0) AS EndingUnits,
    coalesce(CAST(SUM(CAST(EndingRetailValue AS DECIMAL(28,4))) AS DOUBLE), 0) AS EndingRetailValue,
    CAST(coalesce(SUM(LowInventoryFlag), 0) AS DOUBLE) AS LowInventoryFlag
FROM posx GROUP BY 1 ORDER BY 4 DESC, 1 LIMIT 30"""
CTES["c_risk"] = """
SELECT * FROM risk ORDER BY RiskFlagCount DESC, TotalPurchaseDollars DESC, VendorNumber, VendorName LIMIT 40"""
CTES["c_lead"] = """
SELECT * FROM lead_sup ORDER BY MedianLeadTimeDays DESC, VendorNumber, VendorName LIMIT 25"""
CTES["c_status"] = "SELECT PerformanceStatus, count(*) AS SupplierCount FROM card GROUP BY 1"
CTES["c_kpis"] = """
SELECT * FROM (SELECT SUM(BeginningUnits) AS BeginningUnits, SUM(EndingUnits) AS EndingUnits,
    CAST(SUM(CAST(EndingRetailValue AS DECIMAL(28,4))) AS DOUBLE) AS EndingRetailValue,
    CAST(SUM(LowInventoryFlag) AS DOUBLE) AS LowInventoryFlags,
    CAST(SUM(EndingAvailable) AS DOUBLE) / count(EndingUnits) AS AvailabilityRate
    FROM posx) UNPIVOT (Value FOR Metric IN (COLUMNS(*)))"""

# ---- exploration ---------------------------------------------------------------------

CTES["by_desc"] = f"""
SELECT Description, {msum('TotalSalesDollars')} AS TotalSalesDollars,
    {fsum('ProfitMargin')} / count(ProfitMargin) AS ProfitMargin FROM good GROUP BY 1"""
CTES["desc_cuts"] = """
SELECT quantile_cont(TotalSalesDollars, 0.15) AS ls, quantile_cont(ProfitMargin, 0.85) AS hm FROM by_desc"""
CTES["by_name"] = f"""
SELECT VendorName, p, g, s, p / CAST(SUM(CAST(p AS DECIMAL(28,10))) OVER () AS DOUBLE) * 100 AS x FROM (
    SELECT VendorName, {msum('TotalPurchaseDollars')} AS p, {fsum('GrossProfit')} AS g,
        {msum('TotalSalesDollars')} AS s FROM good GROUP BY 1)"""
CTES["name_top"] = """
SELECT *, round_even(x * 100, 0) / 100 AS pc FROM by_name ORDER BY x DESC NULLS LAST, VendorName LIMIT 10"""
CTES["lines"] = """
SELECT VendorNumber, Brand, PONumber, CAST(SUM(Quantity) AS BIGINT) AS OrderQuantity,
    CAST(SUM(Quantity * CAST(PurchasePrice AS DECIMAL(18,4))) FILTER (PurchasePrice > 0) AS DOUBLE)
        / CAST(SUM(Quantity) FILTER (PurchasePrice > 0) AS DOUBLE) AS PurchasePrice
FROM buy GROUP BY 1, 2, 3 HAVING SUM(Quantity) FILTER (PurchasePrice > 0) > 0"""
CTES["sized"] = """
SELECT *, CASE WHEN rn <= (n + 1) // 3 THEN 'Small' WHEN rn <= (n + 1) // 3 + n // 3 THEN 'Medium'
    ELSE 'Large' END AS OrderSize
FROM (SELECT *, row_number() OVER (ORDER BY OrderQuantity, VendorNumber, Brand, PONumber) AS rn,
    count(*) OVER () AS n FROM lines)"""
CTES["vlevel"] = f"""
SELECT VendorNumber, VendorName, {msum('TotalSalesDollars')} AS TotalSalesDollars, {fsum('GrossProfit')} AS GrossProfit,
    CASE WHEN {msum('TotalSalesDollars')} > 0 THEN {fsum('GrossProfit')} / {msum('TotalSalesDollars')} * 100 END
        AS ProfitMargin FROM good GROUP BY 1, 2"""
CTES["vgroups"] = """
SELECT 'Top' AS SalesGroup, ProfitMargin FROM vlevel
WHERE TotalSalesDollars >= (SELECT quantile_cont(TotalSalesDollars, 0.75) FROM vlevel) AND ProfitMargin IS NOT NULL
UNION ALL SELECT 'Low', ProfitMargin FROM vlevel
WHERE TotalSalesDollars <= (SELECT quantile_cont(TotalSalesDollars, 0.25) FROM vlevel) AND ProfitMargin IS NOT NULL"""
CTES["vmom"] = """
SELECT SalesGroup, count(*) AS n, avg(ProfitMargin) AS m, stddev_samp(ProfitMargin) AS sd,
    var_samp(ProfitMargin) AS va FROM vgroups GROUP BY 1"""


def statement(body: str) -> str:
    """A complete statement: ``body`` with every common table expression it needs."""
    order: list[str] = []

    def visit(text: str, trail: tuple[str, ...]) -> None:
        for name in CTES:
            if name in order or name in trail:
                continue
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s*{name}\b\s*(WHERE|,|$)", text):
                visit(CTES[name], (*trail, name))
                order.append(name)

    visit(body, ())
    clauses = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in order)
    return f"WITH {clauses}\n{body.strip()}" if clauses else body.strip()

"""Published tables: staged writes, an all-or-nothing switch, snapshots, exports and reports.

Each run writes its tables under its own folder. A manifest names the folder of every published
table; the one with the highest number is the newest snapshot. Publishing claims the next number,
which only one writer can take, waits for the writers of lower numbers, and then writes a manifest
that adds its tables to what they have published. So readers see either all tables of a run or none,
a failed run leaves the old tables in place, and writers of different tables keep each other's.

Publishing deletes nothing: a frame planned on an earlier snapshot can still be run, and any
snapshot can be read by its number until ``expire`` removes it.
"""

from __future__ import annotations

import json
import logging
import re
import time
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.workspace import CODEC, shuffles_go
from ..operators.quality import DataQualityError
from . import files
from .csv_source import (
    invalid_examples,
    parse_columns,
    read_text_columns,
    require_closed_quotes,
    require_sources,
)
from .schemas import SOURCE_TABLES

log = logging.getLogger(__name__)
_NUMBERED = re.compile(r"(CLAIM|MANIFEST)-(\d{9,})\.json")


class Snapshot:
    """The tables of one manifest; whatever is published later, it stays the same."""

    def __init__(self, spark: SparkSession, root: str, number: int, tables: Mapping[str, str]):
        self._spark, self._root = spark, root
        self.number, self.tables = number, dict(tables)

    def table(self, name: str, *columns: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"table {name} is not published in {self._root} (snapshot {self.number})")
        frame = self._spark.read.parquet(self.tables[name])
        return frame.select(*columns) if columns else frame


class TableStore:
    """Tables under one root folder. ``patience``: seconds after which a writer that has claimed a
    number and written no manifest counts as dead."""

    def __init__(self, spark: SparkSession, root: str, patience: float = 60.0):
        self._spark, self._root, self._patience = spark, root.rstrip("/"), patience

    def _numbers(self) -> tuple[set[int], set[int]]:
        """Numbers that are claimed, and numbers that have a manifest, complete or not."""
        found = [_NUMBERED.fullmatch(n) for n in files.names(self._spark, self._root)]
        claims, manifests = set(), set()
        for m in found:
            if m:
                (claims if m[1] == "CLAIM" else manifests).add(int(m[2]))
        return claims, manifests

    def _path(self, kind: str, number: int) -> str:
        return f"{self._root}/{kind}-{number:09d}.json"

    def _manifest(self, number: int) -> dict | None:
        """A complete manifest: its base, time and tables; None if there is none (yet)."""
        try:
            return json.loads(files.read_text(self._spark, self._path("MANIFEST", number)))
        except ValueError:  # not written to its end
            return None
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception):
                return None
            raise

    def _newest(self, below: int | None = None) -> tuple[int, dict]:
        """The highest complete manifest, with its number; 0 if there is none."""
        for number in sorted(self._numbers()[1], reverse=True):
            if below is None or number < below:
                found = self._manifest(number)
                if found is not None:
                    return number, found
        return 0, {"base": 0, "time": 0.0, "tables": {}}

    def snapshot(self, at: int | None = None) -> Snapshot:
        """The newest snapshot, or that of a number, for reading while others publish."""
        if at is None:
            number, found = self._newest()
            return Snapshot(self._spark, self._root, number, found["tables"])
        found = self._manifest(at)
        if found is None:
            raise KeyError(f"{self._root} has no snapshot {at}")
        return Snapshot(self._spark, self._root, at, found["tables"])

    def snapshots(self) -> list[int]:
        """Numbers of the snapshots that can be read, the newest last."""
        return [n for n in sorted(self._numbers()[1]) if self._manifest(n) is not None]

    def published(self) -> dict[str, str]:
        """Published table names and where each lies."""
        return self.snapshot().tables

    def table(self, name: str, *columns: str, at: int | None = None) -> DataFrame:
        return self.snapshot(at).table(name, *columns)

    def new_run(self) -> str:
        return f"{self._root}/runs/{uuid.uuid4().hex}"

    def stage(
        self, df: DataFrame, name: str, run: str, allow_empty: bool = True
    ) -> tuple[str, int]:
        """Write one table of a run; the rows read must equal the rows found afterwards."""
        path = f"{run}/{name}"
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        with shuffles_go(self._spark):
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=CODEC)
            actual = self._spark.read.schema(df.schema).parquet(path).count()
        expected = seen.get["rows"]
        if actual != expected:
            raise DataQualityError(f"{name}: read {expected} rows, staged {actual}")
        if not allow_empty and actual == 0:
            raise DataQualityError(f"no data rows found for {name}")
        return path, actual

    def publish(self, staged: Mapping[str, str]) -> int:
        """Make all staged tables visible at once; returns the number of the new snapshot.

        Only creating a claim must be exclusive. A writer waits until every lower claim has its
        manifest, or has been without one for ``patience``, before it merges; one that took longer
        itself looks whether a later writer passed it by, and if so publishes again on top of that.
        """
        while True:
            began = time.monotonic()
            claims, manifests = self._numbers()
            number = max(claims | manifests, default=0) + 1
            if not files.claim(self._spark, self._path("CLAIM", number), uuid.uuid4().hex):
                continue
            self._await(self._newest(below=number)[0], number)
            base, before = self._newest(below=number)
            text = json.dumps(
                {"base": base, "time": time.time(), "tables": {**before["tables"], **staged}}, indent=1, sort_keys=True
            )
            files.write_text(self._spark, self._path("MANIFEST", number), text)
            if time.monotonic() - began < self._patience or self._carried(number):
                return number

    def _await(self, above: int, below: int | None = None) -> None:
        """Wait until all claims between these numbers have their manifests, for ``patience`` at most."""
        end = time.monotonic() + self._patience
        while time.monotonic() < end:
            open_ = [n for n in self._numbers()[0] if n > above and (below is None or n < below) and self._manifest(n) is None]
            if not open_:
                return
            time.sleep(0.02)

    def _carried(self, number: int) -> bool:
        """Whether the newest manifest was built on this one, through however many others."""
        self._await(number)
        at, found = self._newest()
        while at > number:
            at = found["base"]
            found = self._manifest(at) or {"base": 0}
        return at == number

    def expire(self, keep: int = 1, older_than: float = 0.0) -> list[str]:
        """Delete old snapshots: all but the newest ``keep`` and those of the last ``older_than`` seconds.

        Returns the table folders that were deleted: those that an expired snapshot names and no kept
        one does. Staged tables that were never published are not touched. Frames planned on an
        expired snapshot fail when they are run, so ``older_than`` should exceed the longest job.
        """
        if keep < 1:
            raise ValueError("the newest snapshot cannot expire")
        found = {n: self._manifest(n) for n in self.snapshots()}
        now, newest = time.time(), sorted(found)[-keep:]
        kept = {n for n, m in found.items() if n in newest or now - m["time"] < older_than}
        needed = {path for n in kept for path in found[n]["tables"].values()}
        gone = {path for n in set(found) - kept for path in found[n]["tables"].values()} - needed
        for n in set(found) - kept:
            files.remove(self._spark, self._path("MANIFEST", n))
        for n in self._numbers()[0]:
            if n < max(kept, default=0):
                files.remove(self._spark, self._path("CLAIM", n))
        for path in sorted(gone):
            files.remove(self._spark, path)
            files.remove_if_empty(self._spark, path.rsplit("/", 1)[0])
        return sorted(gone)

    def discard(self, run: str) -> None:
        """Delete what a run that will not be published has staged."""
        files.remove(self._spark, run)

    def register_views(self) -> list[str]:
        """Make every published table known to ``spark.sql`` by its name."""
        names = sorted(self.published())
        for name in names:
            self.table(name).createOrReplaceTempView(name)
        return names


def ingest(
    spark: SparkSession, folder: str, store: TableStore, threads: int = 6, multi_line: bool = False
) -> dict[str, int]:
    """Load the six extracts and publish them together; returns the row counts.

    The tables are independent jobs and share the cluster's free slots. ``multi_line`` reads
    quoted line breaks, at the price of a further scan and a written copy of the records. What is
    replaced stays until ``store.expire``. A failed run is deleted.
    """
    require_sources(spark, folder)
    run = store.new_run()

    def load(table: str) -> tuple[str, str, int]:
        if not multi_line:
            require_closed_quotes(spark, folder, table)
        text = read_text_columns(spark, folder, table, multi_line)
        try:
            path, rows = store.stage(parse_columns(text, table), table, run, allow_empty=False)
        except DataQualityError:
            raise
        except Exception as error:
            examples = invalid_examples(text, table)
            if examples:
                raise DataQualityError(f"invalid values in {table}.csv: {examples}") from error
            raise
        log.info("staged %s: %s rows", table, rows)
        return table, path, rows

    try:
        with ThreadPoolExecutor(threads) as pool:
            loaded = list(pool.map(load, SOURCE_TABLES))
    except Exception:
        store.discard(run)
        raise
    store.publish({table: path for table, path, _ in loaded})
    return {table: rows for table, _, rows in loaded}


# The analytical tables an export covers.
EXPORT_TABLES = (
    "vendor_sales_summary", "vendor_performance_summary", "Vendor_Purchase_Summary",
    "LowTurnoverVendor", "BrandPerformance", "purchase_order_summary", "inventory_position",
    "dim_supplier", "dim_brand", "dim_store", "dim_date", "fact_purchase_order",
    "fact_lead_time", "supplier_lead_time_summary", "brand_lead_time_summary",
    "fact_delivery_reconciliation", "fact_supplier_performance", "procurement_planning_risk",
    "po_cycle_aging_summary", "fact_procurement_monthly", "fact_inventory_summary",
)


def write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """Write a CSV folder that ``csv_source`` reads back as it was, blanks at the ends included.

    ``packed`` writes gzip files, a third of the size; a file of them is read by one task, and every task
    writes its own.
    """
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if packed:
        options |= {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    with shuffles_go(df.sparkSession):
        df.write.mode("overwrite").options(**options).csv(path)


def export_csv(
    store: TableStore, out: str, tables: Iterable[str] = EXPORT_TABLES, packed: bool = False
) -> list[str]:
    """Write the published tables among ``tables`` as CSV folders; absent ones are skipped."""
    present = store.published()
    written = [t for t in tables if t in present]
    for name in written:
        write_csv(store.table(name), f"{out.rstrip('/')}/{name}", packed)
    return written


# Scorecard columns of the planning extract and its notes.
SCORECARD_COLUMNS = (
    "VendorNumber", "VendorName", "PurchaseOrderKeyCount", "MatchedPOCount",
    "TotalPurchaseDollars", "TotalPurchaseQuantity", "AverageLeadTimeDays",
    "MedianLeadTimeDays", "LeadTimeVarianceDays", "LeadTimeStdDevDays", "InvoiceMatchRatePct",
    "QuantityAlignmentRatePct", "DollarAlignmentRatePct", "AbsoluteAvgPriceVariancePct",
    "EstimatedEndingInventoryCost", "EligibleInventoryTurnover", "SupplierPerformanceScore",
    "PerformanceStatus", "OTIFSupported", "OTIFLimitationNote",
)
METHODOLOGY_NOTES = (
    "True OTIF is not supported by source fields.",
    "Delivery metrics are invoice reconciliation rates.",
    "PO aging buckets are observed cycle-time (PO to last receipt), not open-PO aging.",
    "Vendor inventory exposure only for single-vendor complete-snapshot brands.",
)


def scorecard_columns(performance: DataFrame) -> DataFrame:
    """The extract's scorecard columns, as far as they exist."""
    return performance.select(*[c for c in SCORECARD_COLUMNS if c in performance.columns])


def planning_extract(
    spark: SparkSession, tables: Mapping[str, DataFrame], anchors: Mapping[str, object]
) -> dict[str, DataFrame]:
    """The parts of the procurement planning extract."""
    notes = [*METHODOLOGY_NOTES, *[f"{name}: {value}" for name, value in anchors.items()]]
    rows = F.explode(F.array(*[F.lit(n) for n in notes])).alias("Note")
    return {
        "Supplier Scorecard": scorecard_columns(tables["fact_supplier_performance"]),
        "Procurement Planning Risk": tables["procurement_planning_risk"],
        "PO Cycle Aging": tables["po_cycle_aging_summary"],
        "Supplier Lead Time": tables["supplier_lead_time_summary"],
        "Monthly Spend Sample": tables["fact_procurement_monthly"],
        "Methodology Notes": spark.range(1).select(rows),
    }


def write_extract(parts: Mapping[str, DataFrame], out: str, packed: bool = False) -> list[str]:
    for name, df in parts.items():
        write_csv(df, f"{out.rstrip('/')}/{name.replace(' ', '_')}", packed)
    return list(parts)


def write_report(one_row: DataFrame, path: str) -> None:
    """A one-row report as one JSON document."""
    one_row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)

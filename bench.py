"""Time the headline queries, the CSV ingest and the full build; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores.
Results go to Spark's noop sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from supplylens.functions.workspace import release
from supplylens.plans.model import Model, build
from supplylens.plans.registry import QUERIES
from supplylens.sources.readers import ParquetSources, StarSchemaSources
from supplylens.sources.schemas import SOURCE_TABLES
from supplylens.sources.store import TableStore, ingest

HEADLINE = (
    "purchase_order_summary", "delivery_reconciliation", "inventory_position",
    "vendor_sales_summary", "procurement_monthly", "dim_supplier", "brand_lead_time",
    "vendor_performance", "planning_risk", "audit", "stats_tertiles",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("supplylens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-shared-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def write_extracts(spark: SparkSession, folder: str, out: str) -> None:
    """The six source tables as CSV; the files the ingest reads. Not timed."""
    src = StarSchemaSources(spark, folder)
    for table in SOURCE_TABLES:
        src.table(table).write.option("header", True).option("escape", '"').csv(f"{out}/{table}.csv")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = session()
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    drain(QUERIES["inventory_position"](spark, folder))  # start the JVM's compilers
    for name in HEADLINE:
        timed(name, lambda name=name: drain(QUERIES[name](spark, folder)))

    write_extracts(spark, folder, f"{scratch}/csv")
    store = TableStore(spark, f"{scratch}/store")
    rows: dict[str, int] = {}
    timed("ingest_csv", lambda: rows.update(ingest(spark, f"{scratch}/csv", store)))

    sources = {t: store.published()[t] for t in SOURCE_TABLES}
    parquet = ParquetSources(spark, os.path.dirname(sources["purchases"]))
    timed(
        "vendor_summary_and_reconciliation",
        lambda: drain(Model(parquet).summary_checks()),
    )
    tables: dict[str, int] = {}
    timed("build_all_tables", lambda: tables.update(build(spark, parquet, store)))
    release(spark)

    total = sum(rows.values())
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "ingest_rows": total,
                "ingest_rows_per_sec": round(total / times["ingest_csv"]),
                "build_input_rows_per_sec": round(
                    (rows["purchases"] + rows["sales"]) / times["build_all_tables"]
                ),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""CSV ingest, publishing and exports, with the ways they must fail."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from supplylens.operators.quality import DataQualityError
from supplylens.sources import catalog, files
from supplylens.sources.csv_source import CsvSources, parsed_date, read_source, require_sources
from supplylens.sources.quoted_lines import quoted_records
from supplylens.sources.schemas import SOURCE_COLUMNS, SOURCE_TABLES
from supplylens.sources.store import TableStore, export_csv, ingest, write_report

ROW = {"bigint": "1", "double": "2.5", "date": "2024-01-05", "string": "text"}


def write(folder: Path, table: str, rows: list[dict[str, str]], order=None) -> None:
    columns = order or list(SOURCE_COLUMNS[table])
    lines = [",".join(columns)]
    for row in rows:
        full = {c: ROW[t] for c, t in SOURCE_COLUMNS[table].items()} | row
        lines.append(",".join(full.get(c, "") for c in columns))
    (folder / f"{table}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def extracts(tmp_path) -> Path:
    for table in SOURCE_TABLES:
        write(tmp_path, table, [{}, {"Description": '"a, ""b"""'} if table == "sales" else {}])
    return tmp_path


def test_missing_files_are_all_named(spark, extracts):
    (extracts / "sales.csv").rename(extracts / "sales.txt")
    (extracts / "purchases.csv").rename(extracts / "purchases.txt")
    with pytest.raises(FileNotFoundError, match="purchases.csv.*sales.csv"):
        require_sources(spark, str(extracts))


def test_columns_match_by_header_name(spark, extracts):
    swapped = list(reversed(SOURCE_COLUMNS["vendor_invoice"])) + ["Extra"]
    write(extracts, "vendor_invoice", [{"PONumber": "77", "Extra": "kept", "Freight": "NULL"}], swapped)
    row = read_source(spark, str(extracts), "vendor_invoice").first()
    assert row.PONumber == 77 and row.Freight is None and row.Extra == "kept"


def test_values_are_typed(spark, extracts):
    write(extracts, "purchases", [{"PODate": "2024-1-5", "ReceivingDate": "", "PurchasePrice": "n/a"}])
    row = read_source(spark, str(extracts), "purchases").first()
    assert row.PODate == dt.date(2024, 1, 5) and row.ReceivingDate is None and row.PurchasePrice is None
    assert [t for _, t in read_source(spark, str(extracts), "purchases").dtypes] == list(SOURCE_COLUMNS["purchases"].values())
    assert read_source(spark, str(extracts), "sales").collect()[1].Description == 'a, "b"'


@pytest.mark.parametrize(("column", "value"), [("PODate", "2024-13-01"), ("Quantity", "many")])
def test_bad_values_fail_with_examples(spark, extracts, column, value):
    write(extracts, "purchases", [{column: value}] * 5)
    store = TableStore(spark, str(extracts / "store"))
    with pytest.raises(DataQualityError, match=f"{column}.*{value}"):
        ingest(spark, str(extracts), store)
    assert store.published() == {}


def test_empty_extract_fails(spark, extracts):
    write(extracts, "sales", [])
    with pytest.raises(DataQualityError, match="sales"):
        ingest(spark, str(extracts), TableStore(spark, str(extracts / "store")))


def test_failed_ingest_leaves_old_tables(spark, extracts):
    store = TableStore(spark, str(extracts / "store"))
    assert ingest(spark, str(extracts), store) == dict.fromkeys(SOURCE_TABLES, 2)
    before = store.published()
    write(extracts, "sales", [{"SalesDate": "yesterday"}])
    write(extracts, "purchases", [{}] * 9)
    with pytest.raises(DataQualityError):
        ingest(spark, str(extracts), store)
    assert store.published() == before and store.table("purchases").count() == 2


def test_second_ingest_replaces_all(spark, extracts):
    store = TableStore(spark, str(extracts / "store"))
    ingest(spark, str(extracts), store)
    write(extracts, "purchases", [{}] * 3)
    assert ingest(spark, str(extracts), store)["purchases"] == 3
    assert store.table("purchases", "PONumber").count() == 3
    with pytest.raises(KeyError):
        store.table("nothing")


def test_exports_skip_absent_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    run = store.new_run()
    path, rows = store.stage(spark.range(3).selectExpr("id AS Store", "'x' AS City"), "dim_store", run)
    assert rows == 3
    store.publish({"dim_store": path})
    assert export_csv(store, str(tmp_path / "out")) == ["dim_store"]
    assert spark.read.csv(str(tmp_path / "out" / "dim_store"), header=True).count() == 3
    assert store.register_views() == ["dim_store"] and "dim_store" in catalog.list_tables(spark)
    assert catalog.run_query(spark, "SELECT count(*) AS n FROM dim_store").first().n == 3
    assert catalog.preview(spark.table("dim_store"), 2).count() == 2
    listed = [tuple(r) for r in catalog.list_columns(store.table("dim_store"), "dim_store").collect()]
    assert listed == [("dim_store", "Store", "bigint"), ("dim_store", "City", "string")]


def test_report_is_one_json_document(spark, tmp_path):
    write_report(spark.sql("SELECT 1 AS a, CAST(NULL AS double) AS b"), str(tmp_path / "report"))
    [part] = (tmp_path / "report").glob("part-*.json")
    assert json.loads(part.read_text()) == {"a": 1, "b": None}


def test_csv_sources_prune_columns(spark, extracts):
    assert CsvSources(spark, str(extracts)).table("sales", "Brand", "Store").columns == ["Brand", "Store"]


def test_whole_numbers_may_have_a_decimal_point(spark, extracts):
    write(extracts, "purchases", [{"Quantity": "4.0", "Store": " 7 "}, {"Quantity": "12345678901234567"}])
    rows = read_source(spark, str(extracts), "purchases").collect()
    assert [r.Quantity for r in rows] == [4, 12345678901234567] and rows[0].Store == 7
    write(extracts, "purchases", [{"Quantity": "4.5"}])
    with pytest.raises(DataQualityError, match="Quantity.*4.5"):
        ingest(spark, str(extracts), TableStore(spark, str(extracts / "store")))


@pytest.mark.parametrize("more", [",EXTRA", ",a,b", ",,EXTRA", ',"",,"x,y"', ","])
def test_surplus_fields_fail(spark, extracts, more):
    path = extracts / "sales.csv"
    path.write_text(path.read_text().rstrip("\n") + more + "\n")
    store = TableStore(spark, str(extracts / "store"))
    with pytest.raises(Exception, match="more fields than the header"):
        ingest(spark, str(extracts), store)
    assert store.published() == {} and not list((extracts / "store").glob("runs/*"))


def test_missing_last_fields_are_null(spark, extracts):
    path = extracts / "vendor_invoice.csv"
    lines = path.read_text().split("\n")
    path.write_text("\n".join([lines[0], lines[1].rsplit(",", 2)[0], *lines[2:]]))
    rows = read_source(spark, str(extracts), "vendor_invoice").collect()
    assert sorted((r.Freight is None, r.Approval is None) for r in rows) == [(False, False), (True, True)]


def test_quoted_line_breaks_need_multi_line(spark, extracts):
    write(extracts, "sales", [{"Description": '"first\nsecond"'}])
    store = TableStore(spark, str(extracts / "store"))
    with pytest.raises(DataQualityError, match="multi_line"):
        ingest(spark, str(extracts), store)
    assert ingest(spark, str(extracts), store, multi_line=True)["sales"] == 1
    assert store.table("sales").first().Description == "first\nsecond"
    write(extracts, "sales", [{"Description": '"never closed'}])
    with pytest.raises(DataQualityError, match="not closed"):
        ingest(spark, str(extracts), store, multi_line=True)


def test_writers_of_different_tables_keep_each_other(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))

    def write_one(k: int) -> None:
        path, _ = store.stage(spark.range(k + 1), f"t{k}", store.new_run())
        store.publish({f"t{k}": path})

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write_one, range(12)))
    assert {n: store.table(n).count() for n in store.published()} == {f"t{k}": k + 1 for k in range(12)}


def _publish(spark, store, n: int, name: str = "t") -> int:
    path, _ = store.stage(spark.range(n), name, store.new_run())
    return store.publish({name: path})


def test_frames_outlive_later_publishes(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    first = _publish(spark, store, 2)
    frame, pinned = store.table("t"), store.snapshot()
    _publish(spark, store, 5)
    _publish(spark, store, 7, "other")
    assert frame.count() == 2 and pinned.table("t").count() == 2 and store.table("t").count() == 5
    assert store.table("t", at=first).count() == 2 and store.snapshots() == [1, 2, 3]
    with pytest.raises(KeyError):
        pinned.table("other")
    with pytest.raises(KeyError):
        store.snapshot(9)


def test_expire_removes_what_no_kept_snapshot_names(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    kept_by_all, _ = store.stage(spark.range(1), "same", store.new_run())
    store.publish({"same": kept_by_all})
    for n in (2, 5, 9):
        _publish(spark, store, n)
    unpublished, _ = store.stage(spark.range(3), "later", store.new_run())
    assert store.expire(keep=1, older_than=3600) == [] and len(store.snapshots()) == 4
    old = [store.snapshot(n).tables["t"] for n in (2, 3)]
    assert store.expire(keep=2) == [old[0]] and store.snapshots() == [3, 4]
    assert store.expire() == [old[1]] and store.expire() == [] and store.snapshots() == [4]
    assert {store.table("t").count(), store.table("same").count()} == {9, 1}
    assert sorted(str(p) for p in (tmp_path / "store").glob("runs/*/*")) == sorted(
        [kept_by_all, store.published()["t"], unpublished]
    )
    assert {p.name for p in (tmp_path / "store").glob("*.json")} == {"MANIFEST-000000004.json", "CLAIM-000000004.json"}
    with pytest.raises(ValueError, match="newest"):
        store.expire(keep=0)
    assert _publish(spark, store, 3) == 5


def test_a_dead_writer_is_passed_by(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"), patience=0.3)
    _publish(spark, store, 2)
    assert files.claim(spark, store._path("CLAIM", 2), "dead") and not files.claim(spark, store._path("CLAIM", 2), "late")
    (tmp_path / "store" / "MANIFEST-000000002.json").write_text('{"base": 1, "tab')  # died while writing
    assert store.table("t").count() == 2
    assert _publish(spark, store, 4, "other") == 3 and store.snapshots() == [1, 3]
    assert set(store.published()) == {"t", "other"}


def test_a_writer_that_was_passed_by_publishes_again(spark, tmp_path, monkeypatch):
    slow, quick = (TableStore(spark, str(tmp_path / "store"), patience=0.2) for _ in range(2))
    paths = {n: slow.stage(spark.range(1), n, slow.new_run())[0] for n in ("a", "b")}
    write, first = files.write_text, []

    def paused(spark, path, text):
        if not first:  # the slow writer stops after its claim, longer than anyone waits
            first.append(path)
            assert quick.publish({"b": paths["b"]}) == 2
        write(spark, path, text)

    monkeypatch.setattr(files, "write_text", paused)
    assert slow.publish({"a": paths["a"]}) == 3
    assert slow.published() == paths


_RACER = """
import sys
from pyspark.sql import SparkSession
from supplylens.sources.store import TableStore
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", sys.argv[1] + "/warehouse-" + sys.argv[2]).getOrCreate())
store = TableStore(spark, sys.argv[1])
for k in range(50):
    store.publish({f"{sys.argv[2]}-{k}": "somewhere"})
"""


def test_two_processes_race_and_lose_no_table(spark, tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"PYTHONPATH": f"{repo}:{os.environ.get('PYTHONPATH', '')}"}
    root = str(tmp_path / "store")
    racers = [
        subprocess.Popen([sys.executable, "-c", _RACER, root, name], env=env, cwd=repo, stderr=subprocess.DEVNULL)
        for name in ("a", "b")
    ]
    assert [r.wait(240) for r in racers] == [0, 0]
    store = TableStore(spark, root)
    assert set(store.published()) == {f"{name}-{k}" for name in ("a", "b") for k in range(50)}
    assert store.snapshots() == list(range(1, 101))


def test_lenient_dates(spark):
    rows = spark.createDataFrame([("2024-2-3",), ("soon",), (None,)], "d string").select(parsed_date(F.col("d"))).collect()
    assert [r[0] for r in rows] == [dt.date(2024, 2, 3), None, None]


AWKWARD = ['plain', '"a,b"', '"two\nlines"', '"say ""so"", then\n\n,next"', '""', '" "', '"\n"', '"ends ""x"""', 'é漢', '"\n""\n"']


def _awkward_csv(path: Path, rows: int, seed: int) -> int:
    """A file of quoted line breaks, commas and quotes, with empty lines between records."""
    rng = random.Random(seed)
    lines = ['x,"y\nname",z']
    for k in range(rows):
        lines.append(f"{k},{rng.choice(AWKWARD)},{rng.choice(AWKWARD)}")
        if rng.random() < 0.1:
            lines.append("")
    path.write_text("\n".join(lines) + rng.choice(["", "\n"]))
    return rows


@pytest.mark.parametrize("split", [13, 50, 1 << 20])
def test_records_with_line_breaks_load_alike_at_any_split(spark, tmp_path, split):
    """Borders fall into records, fields, quotes and headers; several lie inside one field."""
    folder = tmp_path / "in"
    folder.mkdir()
    total = sum(_awkward_csv(folder / f"{k}.csv", 30, k) for k in range(2))
    (folder / "empty.csv").write_text("")
    long = '"' + "one\ntwo\n" * 40 + '"'
    (folder / "long.csv").write_text(f"x,y,z\n1,{long},2\n3,4,5\n")
    schema = "x string, y string, z string"
    options = {"quote": '"', "escape": '"'}
    whole = spark.read.options(header=True, multiLine=True, **options).schema(schema).csv(str(folder)).collect()
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = quoted_records(spark, str(folder)).select(F.from_csv("record", schema, options).alias("r")).select("r.*")
        rows = found.collect()
        if split < 100:
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == total + 2
    assert sorted(rows, key=str) == sorted(whole, key=str)


def test_line_breaks_and_surplus_fields_together(spark, extracts):
    path = extracts / "sales.csv"
    path.write_text(path.read_text().rstrip("\n") + ',,"more\nthan that"\n')
    with pytest.raises(Exception, match="more fields than the header"):
        read_source(spark, str(extracts), "sales", multi_line=True).collect()


def test_carriage_returns_at_record_ends_go_and_inside_quotes_stay(spark, extracts):
    path = extracts / "vendor_invoice.csv"
    path.write_bytes(path.read_text().replace("text", '"a\nb"').replace("\n", "\r\n").encode())
    row = read_source(spark, str(extracts), "vendor_invoice", multi_line=True).first()
    assert row.VendorName == "a\r\nb" and row.Approval == "a\r\nb"

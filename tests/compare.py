"""Run registered queries next to their SQL and compare the results value by value.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.date().isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def differences(spark, con, folder: str, name: str, query, sql: str) -> list[str]:
    df = query(spark, folder)
    mine_columns, mine = rows(df.columns, df.collect())
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    their_columns, theirs = rows([d[0] for d in result.description], result.fetchall())
    if mine_columns != their_columns:
        return [f"columns: {set(mine_columns) ^ set(their_columns)}"]
    found = []
    names = {
        "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
        "date": {"DATE"}, "boolean": {"BOOLEAN"},
    }
    for c, t in df.dtypes:
        if kinds[c] not in names.get(t, set()):
            found.append(f"type {c}: {t} / {kinds[c]}")
    if len(mine) != len(theirs):
        found.append(f"rows: {len(mine)} / {len(theirs)}")
    bad = {}
    for a, b in zip(mine, theirs):
        for c, x, y in zip(mine_columns, a, b):
            if x != y:
                bad.setdefault(c, []).append((x, y))
    found += [f"{c}: {len(v)} differ, e.g. {v[0]}" for c, v in bad.items()]
    return found


if __name__ == "__main__":
    from conftest import make_session

    from supplylens.plans.registry import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, con = make_session(), connect(folder)
    failed = []
    for name in chosen:
        start = time.time()
        try:
            if name not in ORACLES:
                print(f"{name:32s} {QUERIES[name](spark, folder).count()} rows, no SQL")
                continue
            found = differences(spark, con, folder, name, QUERIES[name], ORACLES[name])
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{name:32s} {'ok' if not found else 'DIFFERS'} {time.time() - start:6.1f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
        if found:
            failed.append(name)
    print(f"{len(chosen) - len(failed)} of {len(chosen)} agree; differing: {failed}")
    spark.stop()

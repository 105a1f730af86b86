"""Run catalogue queries and compare them with their SQL in DuckDB.

    python tools/check.py [name-part ...]     environment: SF_DIR
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from lakeloom.catalogue import ENTRIES, Tables  # noqa: E402
from lakeloom.session import build_session  # noqa: E402


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def norm(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return str(value).replace("+00:00", "")
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, float):
        return f"f{value!r}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(str(norm(v)) for v in value) + "]"
    return str(value)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(lines, key=lambda t: tuple(str(x) for x in t)), [columns[i] for i in order]


def main(parts):
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("PLAIN"):  # a session without any of this library's settings
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in Tables.NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    bad = []
    for name, entry in ENTRIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = entry.build(Tables(spark, folder))
            got, cols = table([tuple(r) for r in df.collect()], df.columns)
            took = time.time() - start
            if entry.sql is None:
                print(f"rows  {name:45s} {len(got):7d} rows {took:6.2f}s", flush=True)
                continue
            cur = con.execute(entry.sql)
            wide = [d[0] for d in cur.description if str(d[1]).startswith(("HUGEINT", "DECIMAL"))]
            if wide:
                raise AssertionError(f"cast these SQL columns to BIGINT or DOUBLE: {wide}")
            kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
            odd = {c: (k, kinds.get(c)) for c, k in df.dtypes if kinds.get(c) != k}
            want, want_cols = table(cur.fetchall(), [d[0] for d in cur.description])
            if cols != want_cols:
                raise AssertionError(f"columns {cols} != {want_cols}")
            if got != want:
                only = sorted(set(got) - set(want), key=str)[:3]
                miss = sorted(set(want) - set(got), key=str)[:3]
                raise AssertionError(f"{len(got)} vs {len(want)} rows\n   spark {only}\n   sql   {miss}")
            flag = ("" if got else "  EMPTY") + (f"  types {odd}" if odd else "")
            print(f"ok    {name:45s} {len(got):7d} rows {took:6.2f}s{flag}", flush=True)
        except Exception as error:  # noqa: BLE001 - report and go on
            bad.append(name)
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
    print(f"{len(bad)} failures: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])

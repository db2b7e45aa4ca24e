"""Runs registered queries beside their oracle texts and compares names, rows and values.

    python tests/compare.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sort_key(row):
    return tuple((v is None, str(type(v)) if not isinstance(v, (int, float)) else "n",
                  round(v, 4) if isinstance(v, float) else v) for v in row)


def compare(name: str, spark_df, oracle: str, con) -> tuple[bool, str, int]:
    cols = sorted(spark_df.columns)
    got = [tuple(_plain(r[c]) for c in cols) for r in spark_df.collect()]
    cur = con.execute(oracle)
    heads = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    raw = cur.fetchall()
    if sorted(heads) != cols:
        return False, f"columns {cols} vs {sorted(heads)}", len(got)
    at = [heads.index(c) for c in cols]
    want = [tuple(_plain(r[i]) for i in at) for r in raw]
    types = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    odd = [f"{c}:{types[c]}/{kinds[c]}" for c in cols if not _same_kind(types[c], kinds[c])]
    note = f" types {odd}" if odd else ""
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)}" + note, len(got)
    try:
        got.sort(key=_sort_key), want.sort(key=_sort_key)
    except TypeError:
        got.sort(key=str), want.sort(key=str)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0][0]} vs {bad[0][1]}" + note, len(got)
    return not odd, "exact" + note, len(got)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def _same_kind(spark_type: str, duck_type: str) -> bool:
    return _KINDS.get(spark_type, spark_type).lower() == duck_type.lower()


def main() -> int:
    import __spark_entry__ as entry
    from leadlake.session import build_session

    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i:i + 2]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf)
    oracles, failed = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                ok, text, n = compare(name, df, oracles[name], con)
            else:
                n = len(df.collect())
                ok, text = n > 0, "rows only"
        except Exception as error:  # noqa: BLE001 - the report lists every failure
            ok, text, n = False, f"{type(error).__name__}: {str(error)[:600]}", -1
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {n:7d} rows {time.time() - start:6.1f}s  {text}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())

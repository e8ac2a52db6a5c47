"""Run the registered queries beside their SQL and compare names and values.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> str | None:
    """None when equal, else what differs. A cell over the cap may not exist in small tables."""
    df = fn(spark, sf_dir)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    want = table(list(types), cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for c, kind in df.dtypes:
        if kinds.get(kind, kind).upper() != types[c].upper():
            return f"type of {c}: {kind} != {types[c]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{got[0]}: {a} != {b}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from lotledger.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        t = time.time()
        try:
            diff = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:700]}"
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - t:.2f}s {'' if name in sqls else '(rows only)'} {diff or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

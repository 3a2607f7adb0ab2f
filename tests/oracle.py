"""Compare registered queries with their SQL twins: ``python tests/oracle.py [folder] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp_ntz"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v)
    return "NULL" if v is None else str(v)


def compare(spark, con, folder: str, fn, sql: str) -> list[str]:
    """Differences as text; empty when equal."""
    df = fn(spark, folder)
    got = df.collect()
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want = rel.fetchall()
    types = {n: str(c[1]) for n, c in zip(names, rel.description)}
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    kinds = dict(df.dtypes)
    for n in names:
        if KINDS.get(types[n], types[n]) != kinds[n]:
            out.append(f"type of {n}: {kinds[n]} vs {types[n]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} vs {len(want)}")
    cols = sorted(names)
    a = sorted(tuple(_norm(r[c]) for c in cols) for r in got)
    at = [names.index(c) for c in cols]
    b = sorted(tuple(_norm(r[i]) for i in at) for r in want)
    if a != b:
        sa, sb = set(a), set(b)
        out.append(f"values differ {len(sa - sb)}/{len(sb - sa)} {cols}\n   {sorted(sa - sb)[:2]}\n   {sorted(sb - sa)[:2]}")
    return out


def main() -> None:
    import __spark_entry__ as entry
    from kinetable.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    conf = dict(a.split("=") for a in args if "=" in a)
    args = [a for a in args if "=" not in a]
    spark = local_session()
    for k, v in conf.items():
        spark.conf.set(k, v)
    con = connect(folder)
    bad, q, o = 0, entry.queries(), entry.oracle_sql()
    for name in args or q:
        start = time.time()
        try:
            diff = compare(spark, con, folder, q[name], o[name]) if name in o else [f"no oracle, {q[name](spark, folder).count()} rows"]
        except Exception as e:  # report and go on
            diff = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(diff)
        print(f"{'ok ' if not diff else 'BAD'} {name} {time.time() - start:.1f}s", *diff, sep="\n   " if diff else " ", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()

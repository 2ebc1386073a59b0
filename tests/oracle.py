"""Runs queries on Spark, their statements on DuckDB, and compares columns, types and values.

    python -m tests.oracle [folder] [key-prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "float": "FLOAT", "timestamp": "TIMESTAMP", "smallint": "SMALLINT",
}


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (str, int)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(df, con, sql: str) -> tuple[str, int]:
    """('', rows) when equal, else what differs."""
    kinds = {n: t.upper() for n, t, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}
    names = sorted(df.columns)
    if sorted(kinds) != names:
        return f"columns {names} against {sorted(kinds)}", 0
    off = {n: (t, kinds[n]) for n, t in df.dtypes if KINDS.get(t, t) != kinds[n]}
    ours = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    theirs = Counter(
        tuple(plain(v) for v in r)
        for r in con.execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({sql}) q").fetchall())
    rows = sum(ours.values())
    if ours != theirs:
        a, b = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return f"values: {rows} rows against {sum(theirs.values())}\n   spark {a}\n   duck  {b}", rows
    return (f"types {off}" if off else ""), rows


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from gondola.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(), database(folder)
    sqls, bad = oracle_sql(), 0
    for key, fn in queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if key in sqls:
                note, rows = compare(fn(spark, folder), con, sqls[key])
            else:
                rows = len(fn(spark, folder).collect())
                note = "" if rows else "no rows"
        except Exception as e:  # report and go on
            note, rows = f"{type(e).__name__}: {str(e)[:700]}", 0
        bad += bool(note)
        flag = "ok  " if not note else "FAIL"
        empty = " EMPTY" if not rows and not note else ""
        print(f"{flag} {key} rows={rows}{empty} {time.time() - start:.1f}s {'' if key in sqls else '(rows only)'} {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))

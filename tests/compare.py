"""Run every registered query next to its SQL: ``python tests/compare.py [folder] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool):
        return ("n", float(v))
    if v is None or isinstance(v, float) and math.isnan(v):
        return ("0", "")
    if hasattr(v, "is_integer") or isinstance(v, int):
        return ("n", float(v) + 0.0)
    try:
        return ("n", float(v)) if not isinstance(v, str) else ("s", v)
    except (TypeError, ValueError):
        return ("s", str(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results agree, else what differs."""
    got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows vs {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0][0]} vs {bad[0][1]}" if bad else None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from tests.conftest import make_session
    spark, con, sql, failed = make_session(), connect(folder), e.oracle_sql(), 0
    assert set(sql) <= set(e.queries()), set(sql) - set(e.queries())
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            result = difference(df, con, sql[name]) if name in sql else f"rows={df.count()}"
        except Exception as ex:  # noqa: BLE001
            result = f"ERROR {type(ex).__name__}: {str(ex)[:600]}"
        ok = result is None or result.startswith("rows=")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {result or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))

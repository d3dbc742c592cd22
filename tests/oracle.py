"""Compare a registered query with its SQL on DuckDB: columns, row count and values."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return f"{float(value):.9g}" if isinstance(value, (float, decimal.Decimal)) else str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical(x) for x in value) + "]"
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def kind(t: str) -> str:
    """Type family: the driver also compares schemas."""
    t = t.lower()
    if t in ("bigint", "hugeint", "long", "int", "integer", "smallint", "tinyint", "short", "byte"):
        return "integer"
    if t.startswith(("double", "float", "decimal")):
        return "float"
    if t.startswith("timestamp"):
        return "timestamp"
    if t in ("varchar", "string"):
        return "string"
    return t.split("(")[0].split("<")[0]


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = table_of(df.columns, df.collect())
    spent = time.time() - t
    if sql is None:
        return f"rows {len(got)}", spent
    res = con.execute(sql)
    types = {d[0]: str(d[1]) for d in res.description}
    want_cols, want = table_of([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"COLUMNS {got_cols} / {want_cols}", spent
    odd = [(c, t, types[c]) for c, t in df.dtypes if kind(t) != kind(types[c]) and "list" not in types[c].lower()]
    note = f" types {odd}" if odd else ""
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return f"VALUES {len(got)} / {len(want)} rows\n   spark {str(only_got)[:600]}\n   sql   {str(only_want)[:600]}", spent
    return f"ok {len(got)}{note}", spent


def main():
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tests.conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), connect(sf_dir)
    sqls = entry.oracle_sql()
    for n in names:
        try:
            verdict, spent = compare(spark, con, n, entry.queries()[n], sqls.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            verdict, spent = "ERROR " + str(e)[:1500], 0.0
        print(f"{n:32s} {spent:6.2f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()

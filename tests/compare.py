"""Run a registered query on Spark and its oracle on DuckDB and compare the results as sets."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


_FAMILY = {
    "bigint": "int", "int": "int", "integer": "int", "hugeint": "int", "double": "float",
    "string": "text", "varchar": "text", "timestamp_ntz": "timestamp",
}


def _types(pairs):
    return {name: _FAMILY.get(t.lower(), t.lower()) for name, t in pairs}


def differences(name, df, con, sql) -> str | None:
    rows = df.collect()
    cur = con.execute(sql)
    duck_types = _types((d[0], str(d[1])) for d in cur.description)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    have_cols, have = _rows(df.columns, rows)
    if have_cols != want_cols:
        return f"columns {set(have_cols) ^ set(want_cols)}"
    spark_types = _types(df.dtypes)
    if spark_types != duck_types:
        return f"types {[(c, spark_types[c], duck_types[c]) for c in duck_types if spark_types[c] != duck_types[c]]}"
    if have != want:
        more, less = list((have - want).elements()), list((want - have).elements())
        return (
            f"rows spark={sum(have.values())} duck={sum(want.values())} "
            f"only spark {len(more)}: {sorted(more, key=str)[:2]} only duck {len(less)}: {sorted(less, key=str)[:2]} {have_cols}"
        )
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from sparkmart import session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = session.local()
    spark.sparkContext.setLogLevel("OFF")
    con, oracle = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = differences(name, df, con, oracle[name])
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)

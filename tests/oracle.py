"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp", "DATE": "date", "TIMESTAMP WITH TIME ZONE": "timestamp",
}


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _clean(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_clean(r[i]) for i in order)) for r in rows)


def compare(spark, con, name, fn, sql, sf) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} / {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for c, k in df.dtypes:
        if KINDS.get(kinds[c], kinds[c].lower().replace(" ", "")) != k:
            return f"type of {c}: {k} / {kinds[c]}"
    a, b = _rows(df.columns, got), _rows(list(rel.columns), want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"rows {len(a)}/{len(b)}; spark only {only_a[:3]}; sql only {only_b[:3]} ({len(only_a)}/{len(only_b)})"
    return None if a else "EMPTY"


def main(sf: str, wanted: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from cartloom.session import local_session

    spark, con, bad = local_session("oracle", 8), connect(sf), 0
    sql = e.oracle_sql()
    for name, fn in e.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                result = compare(spark, con, name, fn, sql[name], sf)
            else:
                result = None if fn(spark, sf).count() else "EMPTY"
        except Exception as err:  # report and go on with the next query
            result = f"{type(err).__name__}: {str(err)[:1500]}"
        bad += result is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if result is None else result}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

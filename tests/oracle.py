"""Runs registered queries beside their SQL checks and compares the rows.

As a script: python tests/oracle.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return str(value)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, db, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = db.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    mine = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [
        f"{c}: {t} / {sql_types[c]}" for c, t in df.dtypes if kinds.get(t, t) != sql_types[c]
    ]
    if odd:
        return f"types {odd}"
    a, b = rows_of(df.columns, mine), rows_of(sql_columns, theirs)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(argv) -> int:
    from tabloom.catalog import CHECKS, QUERIES
    from tabloom.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    parts = argv[2:]
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = []
    for name, fn in QUERIES.items():
        if parts and not any(p == name or (p.endswith("*") and name.startswith(p[:-1])) for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in CHECKS:
                problem = compare(df, db, CHECKS[name])
                note = "ok" if problem is None else f"DIFF {problem}"
            else:
                rows = df.collect()
                note, problem = f"rows {len(rows)} {rows[:3]}", None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = note = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        if problem:
            failed.append(name)
        print(f"{name:32s} {time.time() - start:6.2f}s {note[:900]}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv))

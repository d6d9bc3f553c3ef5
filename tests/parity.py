"""Run queries and their SQL side by side: ``python tests/parity.py <sf_dir> [name ...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_tables(sf_dir):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_rows, columns, db, sql):
    """None when equal, else a short description."""
    found = db.execute(sql)
    names, want = table_of([d[0] for d in found.description], found.fetchall())
    have_names, have = table_of(columns, spark_rows)
    if names != have_names:
        return f"columns {have_names} instead of {names}"
    if len(have) != len(want):
        return f"{len(have)} rows instead of {len(want)}; {list(set(have) ^ set(want))[:4]}"
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    types = [
        (n, type(h), type(w)) for h, w in zip(have, want) for n, h, w in zip(names, h, w) if type(h) is not type(w)
    ]
    return f"{len(wrong)} rows differ: {wrong[:2]}" if wrong else (f"types {types[:3]}" if types else None)


def main(sf_dir, names):
    import __spark_entry__ as entry
    from newstide.session import local_session

    spark, db = local_session(8, 8), duckdb_tables(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        try:
            start = time.time()
            frame = queries[name](spark, sf_dir)
            rows, took = [tuple(r) for r in frame.collect()], time.time() - start
            if name not in sql:
                print(f"{name:28s} {len(rows):8d} rows {took:7.2f}s  no SQL", flush=True)
                continue
            start = time.time()
            problem = difference(rows, frame.columns, db, sql[name])
            print(
                f"{name:28s} {len(rows):8d} rows {took:7.2f}s  sql {time.time() - start:6.2f}s  "
                f"{'ok' if problem is None else 'DIFFERENT ' + problem[:500]}",
                flush=True,
            )
        except Exception as error:  # keep going: the report covers every query
            print(f"{name:28s} FAILED {str(error)[:500]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

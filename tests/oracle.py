"""Runs registered queries against their SQL counterparts; also usable as a script."""

import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else a short text on the difference."""
    frame = query(spark, sf_dir)
    got = normalized(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = normalized(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"{name}: columns {sorted(frame.columns)} != {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    for field, kind in frame.dtypes:
        if SAME_TYPE.get(kind) != kinds[field]:
            return f"{name}: {field} is {kind}, expected {kinds[field]}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{name}: {a} != {b}"
    return None


def main(sf_dir, names):
    import time

    import __spark_entry__ as entry
    from tapewright.session import local_session

    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        started = time.time()
        if name in oracle:
            try:
                problem = compare(spark, con, name, queries[name], oracle[name], sf_dir)
            except Exception as error:  # report and go on with the next query
                problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        else:
            problem = None if queries[name](spark, sf_dir).count() else f"{name}: no rows"
        kind = "ok  " if problem is None else "FAIL"
        print(f"{kind} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

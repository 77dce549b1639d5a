"""Compare registered queries with their SQL on the same tables."""

import glob
import os

import duckdb

import __spark_entry__ as entry_points


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def difference(spark, con, name, sf_dir):
    """None if equal, else a short description."""
    df = entry_points.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cursor.fetchall())
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows, want {len(want)}; extra {extra}; missing {missing}"

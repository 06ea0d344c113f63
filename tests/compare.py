"""Run a registered query and its SQL, and compare them as multisets of rows."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return str(value) if value is not None else None


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr),
    )


def spark_side(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def sql_side(con, sql):
    result = con.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())

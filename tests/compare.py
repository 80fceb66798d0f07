"""Spark against DuckDB: the same columns and the same rows, in any order."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SMALL = "/root/testdata/sf0.001"


def database(folder=SMALL):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def same_rows(spark_rows, duck_rows):
    """Two pandas frames hold the same rows; columns are compared by name."""
    assert sorted(spark_rows.columns) == sorted(duck_rows.columns)
    shaped = [x[sorted(x.columns)].astype(str).sort_values(sorted(x.columns)).reset_index(drop=True) for x in (spark_rows, duck_rows)]
    assert len(shaped[0]) == len(shaped[1])
    assert shaped[0].equals(shaped[1])

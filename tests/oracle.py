"""Compare registered queries with their SQL in DuckDB."""

import glob
import math
import os
from datetime import datetime

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.isoformat() if isinstance(v, datetime) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())

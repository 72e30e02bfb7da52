"""Compare a Spark result with DuckDB's, value by value, rows in any order."""

import datetime
import math
from decimal import Decimal
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{Path(sf_dir) / table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    return {Decimal: "decimal"}.get(type(value), type(value).__name__)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def kinds(columns, rows):
    found = {}
    for row in rows:
        for c, v in zip(columns, row):
            if v is not None:
                found.setdefault(c, set()).add(_kind(v))
    return found


def difference(spark_df, con, sql):
    """None if equal, else a short account of what differs."""
    spark_rows = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    duck_columns = [d[0] for d in cursor.description]
    duck_rows = cursor.fetchall()
    a_cols, a = normal(spark_df.columns, spark_rows)
    b_cols, b = normal(duck_columns, duck_rows)
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference in {a_cols}:\n  spark {x}\n  duck  {y}"
    ka, kb = kinds(spark_df.columns, spark_rows), kinds(duck_columns, duck_rows)
    return None if ka == kb else f"types { {c: (ka.get(c), kb.get(c)) for c in ka if ka.get(c) != kb.get(c)} }"

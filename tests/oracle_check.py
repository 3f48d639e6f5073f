"""Run queries against their SQL in DuckDB: ``python tests/oracle_check.py [sf] [query ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as comparable text, rows sorted."""
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            text = s.dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        elif pd.api.types.is_bool_dtype(s):
            text = s.astype(str)
        elif pd.api.types.is_numeric_dtype(s):
            text = s.astype("float64").map(lambda x: repr(x + 0.0))
        else:
            text = s.map(lambda x: x if x is None or x is pd.NaT or x != x else str(x))
        out[c] = text.where(s.notna(), "<null>").astype(str)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    a, b = canonical(spark_df), canonical(sql_df)
    unequal = (a != b).any(axis=1)
    if not unequal.any():
        return None
    return f"{int(unequal.sum())} rows differ, first:\n{a[unequal].head(2).to_dict('records')}\n{b[unequal].head(2).to_dict('records')}"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    db, spark = connect(sf_dir), session()
    sql, queries = entry.oracle_sql(), entry.queries()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            got = frame.toPandas()
            took = time.time() - start
            if name not in sql:
                print(f"{name:26s} {took:6.2f}s rows {len(got)} (no SQL)", flush=True)
                continue
            relation = db.sql(sql[name])
            kinds = dict(zip(relation.columns, map(str, relation.types)))
            verdict = compare(got, relation.df())
            print(f"{name:26s} {took:6.2f}s rows {len(got)} {'ok' if verdict is None else 'DIFF ' + verdict}", flush=True)
            if verdict:
                print("   ", dict(frame.dtypes), kinds, flush=True)
            else:
                alike = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "boolean": "BOOLEAN", "date": "DATE"}
                odd = {c: (t, kinds[c]) for c, t in frame.dtypes if alike.get(t) != kinds[c]}
                if odd:
                    print("    types", odd, flush=True)
        except Exception as error:
            print(f"{name:26s} FAIL {type(error).__name__} {str(error)[:800]}", flush=True)

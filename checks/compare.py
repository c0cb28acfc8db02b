"""Run queries in Spark and their SQL in DuckDB, and compare the rows.

``python -m checks.compare /root/testdata/sf0.01 [name ...]``
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import all_queries
from checks.sql import oracle


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def sql_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(r[i] for i in order) for r in result.fetchall()]
    return sorted(columns), sorted(rows, key=repr)


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, db, sql = session(), database(sf_dir), oracle()
    bad = 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        columns, rows = spark_rows(query(spark, sf_dir))
        spark_time, start = time.time() - start, time.time()
        if name not in sql:
            print(f"{name}: {len(rows)} rows, no SQL, {spark_time:.1f} s", flush=True)
            continue
        expected_columns, expected = sql_rows(db, sql[name])
        same = columns == expected_columns and rows == expected
        bad += not same
        print(f"{name}: {'same' if same else 'DIFFERENT'}, {len(rows)} rows, "
              f"Spark {spark_time:.1f} s, SQL {time.time() - start:.1f} s", flush=True)
        if not same:
            print("  ", columns, expected_columns, len(expected))
            differing = [p for p in zip(rows, expected) if p[0] != p[1]][:2]
            for pair in differing:
                print("   ", *[repr(r)[:300] for r in pair], sep="\n      ")
    return bad


if __name__ == "__main__":
    sys.exit(main())

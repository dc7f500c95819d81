"""Run registered queries next to their SQL twins: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    return repr(v)


def normal(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns)) if columns else []


def difference(spark: SparkSession, db, sf_dir: str, name: str) -> str | None:
    """None when both sides agree on names, types and every value; else what differs first."""
    got = queries()[name](spark, sf_dir).toArrow()
    want = db.sql(oracle_sql()[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    types = [(n, str(got.schema.field(n).type), str(want.schema.field(n).type)) for n in got.column_names]
    bad = [t for t in types if t[1].replace("large_", "") != t[2].replace("large_", "")]
    a, b = normal(got), normal(want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; types {bad}"
    if a != b:
        i = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        n = sum(x != y for x, y in zip(a, b))
        return f"{n} of {len(a)} rows differ, {sorted(got.column_names)}: {a[i]} != {b[i]}; types {bad}"
    if not a:
        return "no rows on either side"
    return f"types {bad}" if bad else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, db = session(), database(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                problem = difference(spark, db, sf_dir, name)
                word = "ok" if problem is None else "DIFF " + problem
            else:
                word = f"rows-only {queries()[name](spark, sf_dir).count()}"
                problem = None
        except Exception as error:
            problem = word = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {word}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()

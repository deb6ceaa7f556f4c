"""Run queries against their SQL twins: ``python -m workload.compare [sf] [names]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from nomina.scratch import drop_scratch

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("nomina")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # One machine: any folder of it is shared. On a cluster the setting is given.
        .config("spark.checkpoint.dir", os.environ.get("NOMINA_SCRATCH") or tempfile.mkdtemp(prefix="nomina-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_rows(sf_dir: str, statement: str) -> tuple[list[str], list[tuple]]:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = db.execute(statement)
    return [d[0] for d in result.description], result.fetchall()


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, in a fixed order."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


def mismatch(df: DataFrame, sf_dir: str, name: str) -> str | None:
    """None if the result of a query and its twin agree, else what differs."""
    from workload import ORACLES

    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if ours else "no rows"
    columns, rows = oracle_rows(sf_dir, ORACLES[name])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    theirs = normal(columns, rows)
    if len(ours) != len(theirs):
        return f"{len(ours)} / {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{left} / {right}"
    return None


def main() -> None:
    from workload import QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = session()
    for name in wanted:
        start = time.time()
        try:
            sf_dir = f"/root/testdata/sf{sf}"
            problem = mismatch(QUERIES[name](spark, sf_dir), sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        state = "ok" if problem is None else f"DIFFERS {problem}"
        print(f"{name:24} {time.time() - start:6.1f}s {state}", flush=True)
    drop_scratch(spark)


if __name__ == "__main__":
    main()

"""Run every query and its DuckDB twin at one scale and compare schema and rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.fixtures import BASE_TABLES
from checks.oracles import oracle_sql
from checks.registry import queries

ENGINE_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows, columns, names):
    order = [columns.index(n) for n in names]
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> list[str]:
    df = queries()[name](spark, sf_dir)
    twin = con.sql(oracle_sql()[name])
    names = sorted(df.columns)
    if names != sorted(twin.columns):
        return [f"columns {sorted(set(names) ^ set(twin.columns))}"]
    twin_types = {c: str(t) for c, t in zip(twin.columns, twin.types)}
    found = [f"type of {c}: {t} / {twin_types[c]}" for c, t in df.dtypes if ENGINE_TYPES.get(t) != twin_types[c]]
    ours = _sorted(df.collect(), df.columns, names)
    theirs = _sorted(twin.fetchall(), list(twin.columns), names)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    elif ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(wrong)} rows differ in {names}, first {wrong[0]}")
    return found


def main() -> None:
    sf_dir, *wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in queries():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as failure:  # report and go on with the next query
            found = [str(failure)[:500]]
        bad += bool(found)
        print(f"{name:24s} {'ok' if not found else 'DIFFERS ' + '; '.join(found)} {time.time() - start:.1f}s", flush=True)
    print(f"{bad} of {len(queries())} differ")


if __name__ == "__main__":
    main()

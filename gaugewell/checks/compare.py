"""Run registered queries on Spark and their SQL on DuckDB and compare the values.

    python -m gaugewell.checks.compare [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from gaugewell.checks.oracles import oracle_sql
from gaugewell.checks.registry import queries


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark: SparkSession, con, key: str, sf_dir: str) -> list[str]:
    """Empty when Spark and SQL agree on columns and on every value."""
    found = queries()[key](spark, sf_dir)
    ours = _rows(found.columns, found.collect())
    answer = con.execute(oracle_sql()[key])
    names = [d[0] for d in answer.description]
    theirs = _rows(names, answer.fetchall())
    if sorted(names) != sorted(found.columns):
        return [f"columns {sorted(found.columns)} vs {sorted(names)}"]
    if ours == theirs:
        return []
    only = [f"spark {r}" for r in ours if r not in theirs][:3]
    only += [f"sql   {r}" for r in theirs if r not in ours][:3]
    return [f"{len(ours)} vs {len(theirs)} rows", *only]


def main() -> int:
    from gaugewell.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or list(queries())
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            found = differences(spark, con, key, sf_dir)
        except Exception as error:  # report and go on with the other queries
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {key} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line[:600], flush=True)
    print(f"{len(keys) - bad} of {len(keys)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

"""Run registered queries next to their SQL twins and compare whole results."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def difference(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    found = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in found.collect()]
    if name not in ORACLES:
        return None if rows else "no rows"
    wanted = con.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} against {sorted(columns)}"
    mine, theirs = _canonical(found.columns, rows), _canonical(columns, wanted.fetchall())
    if mine == theirs:
        return None
    only_mine = [r for r in mine if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} against {len(theirs)} rows; {only_mine} / {only_theirs}"


def main(sf_dir: str, names: list[str]) -> int:
    from reviewmart.session import build_session

    spark = build_session("compare", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names or QUERIES:
        start = time.time()
        problem = difference(spark, con, name, sf_dir)
        failures += problem is not None
        seconds = time.time() - start
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {seconds:.1f}s {problem or ''}"[:1500], flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)

"""Compare registered queries with their SQL: python tests/check_oracle.py [sf_dir] [query ...]"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402
from gleanspark.session import session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cursor = connection.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if ours != theirs:
        a, b = set(map(repr, ours)), set(map(repr, theirs))
        return False, f"{len(ours)} vs {len(theirs)} rows\n   spark only: {[x[:600] for x in sorted(a - b)[:2]]}\n   sql only: {[x[:600] for x in sorted(b - a)[:2]]}"
    return True, f"{len(ours)} rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = session("check", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            same, note = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            same, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not same
        print(f"{'ok  ' if same else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())

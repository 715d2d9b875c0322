"""Compare registered queries with their SQL twins, value by value.

``python tests/oracle.py /root/testdata/sf0.01 [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(repr(_plain(row[i])) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


# type names of both engines, by meaning
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def compare(spark, connection, name, sf_dir, queries, oracles) -> str | None:
    """None if equal, else what differs."""
    df = queries[name](spark, sf_dir)
    columns, rows = _rows(df.columns, df.collect())
    result = connection.execute(oracles[name])
    types = {d[0]: str(d[1]) for d in result.description}
    other_columns, other_rows = _rows(list(types), result.fetchall())
    if columns != other_columns:
        return f"columns {columns} != {other_columns}"
    kinds = {f.name: KINDS[f.dataType.simpleString()] for f in df.schema}
    if kinds != types:
        return f"types {sorted(set(kinds.items()) ^ set(types.items()))}"
    if len(rows) != len(other_rows):
        return f"rows {len(rows)} != {len(other_rows)}"
    wrong = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    return f"{len(wrong)} of {len(rows)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as registered
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracles = registered.queries(), registered.oracle_sql()
    for name in names or queries:
        started = time.time()
        try:
            found = compare(spark, connection, name, sf_dir, queries, oracles) or "ok"
        except Exception as error:  # report and go on
            found = f"ERROR {str(error)[:600]}"
        print(f"{name:28s} {time.time() - started:6.1f}s {found}", flush=True)


if __name__ == "__main__":
    main()

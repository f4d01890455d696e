"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6f}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, folder: str) -> str | None:
    """None if both give the same rows, otherwise what differs."""
    result = query(spark, folder)
    ours = _rows(result.columns, result.collect())
    found = connection.execute(sql)
    columns = [entry[0] for entry in found.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} / {sorted(columns)}"
    theirs = _rows(columns, found.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    different = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    if different:
        return f"{len(different)} of {len(ours)} rows differ, first {different[0]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from riskloom.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = local_session(), connect(folder)
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                outcome = f"rows only: {query(spark, folder).count()}"
            else:
                outcome = compare(spark, connection, query, sql, folder) or "ok"
        except Exception as error:  # report and go on
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:7.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()

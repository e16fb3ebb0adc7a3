"""Run registered queries against their reference SQL in DuckDB and report differences.

Usage: python -m checks.compare [scale folder] [query name part ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def shown(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return f"b:{value}"
        if isinstance(value, int):
            return f"i:{value}"
        if isinstance(value, (float,)) or type(value).__name__ == "Decimal":
            return f"f:{float(value) + 0.0:.6f}"
        return f"s:{value}"

    return sorted(tuple(shown(row[place]) for place in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both sides agree on columns and rows."""
    left_columns = spark_df.columns
    left = rows_of(left_columns, [tuple(row) for row in spark_df.collect()])
    cursor = connection.execute(sql)
    right_columns = [column[0] for column in cursor.description]
    right = rows_of(right_columns, cursor.fetchall())
    if sorted(left_columns) != sorted(right_columns):
        return f"columns {sorted(left_columns)} != {sorted(right_columns)}"
    if left == right:
        return None
    only_left, only_right = set(left) - set(right), set(right) - set(left)
    return (
        f"{len(left)} vs {len(right)} rows; {len(only_left)} / {len(only_right)} differ\n"
        f"    spark {sorted(only_left)[:1]}\n    sql   {sorted(only_right)[:1]}"
    )


def main(sf_dir: str, parts: list[str]) -> int:
    from checks import catalog
    from threadloom.session import build_session

    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    failed = 0
    for name, run in catalog.QUERIES.items():
        if parts and not any(part in name for part in parts):
            continue
        start = time.time()
        try:
            result = run(spark, sf_dir)
            if name in catalog.ORACLES:
                problem = difference(result, connection, catalog.ORACLES[name])
                note = "ok" if problem is None else problem
            else:
                problem, note = None, f"{result.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    if not Path(folder).exists():
        raise SystemExit(f"no such folder: {folder}")
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)

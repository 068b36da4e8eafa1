"""Run registered queries on Spark and their SQL on DuckDB, and compare rows.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


# Spark type -> the SQL engine's name for it.
TYPE_NAMES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
}


def compare(spark, connection, sf_dir: str, run, sql: str) -> list[str]:
    """Differences found, as text; none means equal."""
    df = run(spark, sf_dir)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    ours = [tuple(row) for row in df.collect()]
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema:
        expected = TYPE_NAMES.get(field.dataType.simpleString())
        if expected != kinds[field.name]:
            found.append(f"type of {field.name}: {expected} against {kinds[field.name]}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} against {len(theirs)}")
    left, right = rows_of(df.columns, ours), rows_of(names, theirs)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        found.append(f"{len(different)} different rows, columns {sorted(names)}, first {different[0][0]} against {different[0][1]}")
    return found


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from stockspark.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = build_session(
        master="local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problems = compare(spark, connection, sf_dir, run, sql[name])
                note = "ok" if not problems else "; ".join(problems)
                bad += bool(problems)
            else:
                note = f"rows only: {run(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            note = f"FAILED {type(error).__name__}: {str(error)[:700]}"
            bad += 1
        print(f"{name:34s} {time.time() - start:6.1f}s  {note[:1200]}", flush=True)
    print(f"problems: {bad}")


if __name__ == "__main__":
    main()

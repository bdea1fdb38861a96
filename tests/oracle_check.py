"""Compares every query with its SQL over a test folder: python tests/oracle_check.py [folder] [names...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped)


def compare(spark, connection, folder, name, query, sql):
    """None if both sides agree, else a short description of the difference."""
    frame = query(spark, folder)
    mine = as_rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = as_rows(columns, result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] != theirs[1]:
        only_mine = sorted(set(mine[1]) - set(theirs[1]))[:3]
        only_theirs = sorted(set(theirs[1]) - set(mine[1]))[:3]
        return f"rows {len(mine[1])} vs {len(theirs[1])}; only Spark {only_mine}; only SQL {only_theirs}"
    return None if mine[1] else "no rows on either side"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from threadlens.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, connection, failures = local_session(8), duck(folder), 0
    sqls = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, connection, folder, name, query, sqls[name])
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - a check tool reports and goes on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())

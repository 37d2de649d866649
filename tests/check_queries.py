"""Compare every named query with its SQL oracle; also the body of ``test_queries.py``.

Run as a script: ``python tests/check_queries.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events".split()


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if value != value else repr(value)
    return value if value is None else str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    mine = canonical(df.columns, df.collect())
    connection.execute(sql)
    names = [d[0] for d in connection.description]
    theirs = canonical(names, connection.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from swipeline.plans.catalog import all_queries
    from swipeline.plans.oracle import ORACLES
    from swipeline.session import open_session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = open_session(
        master="local[8]", shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(directory)
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            problem = compare(session, connection, query, ORACLES[name], directory) if name in ORACLES else "no oracle"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)

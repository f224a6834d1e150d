"""Run catalog queries next to their SQL and compare the rows.

``python tests/compare.py [folder] [name ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.conftest import make_session  # noqa: E402


def database(folder: str):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and the rows of a SQL query."""
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = Counter(found.fetchall())
    got = Counter(tuple(r) for r in df.select(*names).collect())
    problems = []
    if got != want:
        problems.append(f"rows: {sum(got.values())} != {sum(want.values())}")
        problems.append(f"only here: {list((got - want).items())[:3]}")
        problems.append(f"only in SQL: {list((want - got).items())[:3]}")
    return problems


def main() -> None:
    import __spark_entry__ as spark_entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = make_session()
    connection = database(folder)
    sql = spark_entry.oracle_sql()
    failed = 0
    for name, run in spark_entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            if name in sql:
                problems = differences(run(spark, folder), connection, sql[name])
            else:
                problems = [] if run(spark, folder).count() else ["no rows"]
        except Exception as e:  # report every query, not only the first bad one
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {time.time() - begin:6.2f}s")
        for p in problems:
            print("     ", p)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()

"""Run registered queries next to their SQL in DuckDB and compare all rows.

    python tests/compare.py [tables folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, folder: str, name: str) -> str:
    """Empty if both engines return the same rows under the same column names."""
    result = contract.queries()[name](spark, folder)
    relation = connection.sql(contract.oracle_sql()[name])
    if sorted(result.columns) != sorted(relation.columns):
        return f"columns {sorted(result.columns)} != {sorted(relation.columns)}"
    ours = rows_of(result.columns, result.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if ours == theirs:
        return ""
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; only here {list(only_ours)[:2]}, "
        f"only there {list(only_theirs)[:2]}"
    )


if __name__ == "__main__":
    from conftest import make_session

    session = make_session()
    tables = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.oracle_sql())
    duck = connect(tables)
    failed = 0
    for query_name in names:
        began = time.time()
        try:
            wrong = differences(session, duck, tables, query_name)
        except Exception as error:  # report and go on with the next query
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok':4} {query_name:30} {time.time() - began:6.1f}s {wrong}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")

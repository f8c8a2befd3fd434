"""Compare every registered query with its SQL: ``python tests/check_oracle.py [sf_dir] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402
from tests.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def kinds(table) -> dict[str, str]:
    return {field.name: str(field.type).replace("large_", "") for field in table.schema}


def sorted_rows(table):
    """Rows as sortable text, columns by name."""
    names = sorted(table.column_names)
    columns = [table[name].to_pylist() for name in names]
    return names, sorted(tuple(map(repr, row)) for row in zip(*columns))


def compare(spark, connection, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL; nothing if they agree."""
    query, sql = spark_entry.queries()[name], spark_entry.oracle_sql()[name]
    ours = query(spark, sf_dir).toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    found = []
    if kinds(ours) != kinds(theirs):
        found.append(f"columns {kinds(ours)} against {kinds(theirs)}")
        if set(ours.column_names) != set(theirs.column_names):
            return found
    (names, left), (_, right) = sorted_rows(ours), sorted_rows(theirs)
    if len(left) != len(right):
        found.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        only = sorted(set(left) - set(right))[:3], sorted(set(right) - set(left))[:3]
        found.append(f"{names}: {only}")
    return found


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    spark, connection, failed = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.perf_counter()
        if name in spark_entry.oracle_sql():
            found = compare(spark, connection, name, sf_dir)
            failed += bool(found)
            verdict = "; ".join(found)[:1500] or "equal"
        else:
            verdict = f"no SQL, {spark_entry.queries()[name](spark, sf_dir).count()} rows"
        print(f"{name:26s} {time.perf_counter() - start:6.2f}s  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())

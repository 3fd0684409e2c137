"""Compare registered queries with their SQL in DuckDB.

    python tests/compare.py [sf folder] [name part ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.plans.fixtures import BASE  # noqa: E402


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in BASE:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    """One form for values of both engines."""
    if isinstance(value, decimal.Decimal):
        return str(value.normalize()) if value else "0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "int", "hugeint": "int",
    "string": "text", "varchar": "text", "timestamp_ntz": "timestamp", "double": "double", "float": "double",
}


def family(kind: str) -> str:
    kind = kind.lower()
    return FAMILY.get(kind, kind)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str | None:
    """What differs, or None."""
    relation = connection.sql(sql)
    left, right = spark_df.columns, relation.columns
    if sorted(left) != sorted(right):
        return f"columns {sorted(left)} / {sorted(right)}"
    kinds = {c: family(k) for c, k in spark_df.dtypes}
    other = {c: family(str(k)) for c, k in zip(relation.columns, relation.types)}
    odd = {c: (kinds[c], other[c]) for c in left if kinds[c] != other[c]}
    if odd:
        return f"types {odd}"
    ours, theirs = rows_of(left, spark_df.collect()), rows_of(right, relation.fetchall())
    if ours != theirs:
        return f"rows {sum(ours.values())} / {sum(theirs.values())}: {list((ours - theirs).items())[:3]} / {list((theirs - ours).items())[:3]}"
    if not ours:
        return "no rows"
    return None


def main(sf_dir: str, *parts: str) -> None:
    from __spark_entry__ import oracle_sql, queries
    from ledgerloom.session import local_session

    spark, connection, checks = local_session(), oracle(sf_dir), oracle_sql()
    failed = []
    for name, build in queries().items():
        if parts and not any(part in name for part in parts):
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            problem = difference(df, connection, checks[name]) if name in checks else f"(rows only: {df.count()})"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem and not problem.startswith("(rows only"):
            failed.append(name)
        print(f"{time.time() - started:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(*(sys.argv[1:] or ["/root/testdata/sf0.01"]))

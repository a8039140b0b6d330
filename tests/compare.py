"""Run registered queries and their SQL side by side."""

import glob
import math
import os
import time
from decimal import Decimal

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return str(value)
    return repr(value)


def normalized(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, sf_dir: str, run, sql: str) -> str | None:
    """What differs between the two results, or None."""
    df = run(spark, sf_dir)
    expected = duck(sf_dir).execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = normalized(df.columns, df.collect()), normalized(names, expected.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for left, right in zip(got, want):
        if left != right:
            return f"row {left} != {right}"
    return None


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.conftest import local_session

    import __spark_entry__ as entry

    directory = sys.argv[1]
    wanted = [q for q in entry.queries() if not sys.argv[2:] or any(q.startswith(a) for a in sys.argv[2:])]
    session = local_session()
    bad = 0
    for query_name in wanted:
        begin = time.time()
        try:
            if query_name in entry.oracle_sql():
                found = difference(session, directory, entry.queries()[query_name], entry.oracle_sql()[query_name])
            else:
                found = f"no SQL, {entry.queries()[query_name](session, directory).count()} rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None and not found.startswith("no SQL")
        print(f"{'ok ' if found is None else 'BAD'} {query_name} {time.time() - begin:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(wanted)} differ")

"""Run queries beside their SQL: ``python tests/compare.py <sf_dir> [query ...]``."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def differences(spark, con, sf: str, name: str) -> tuple[int, str]:
    """Row count, and what differs (empty when nothing does)."""
    frame = entry_points.queries()[name](spark, sf)
    mine = normal(frame.columns, frame.collect())
    cursor = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    theirs = normal(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return len(mine), f"columns {sorted(frame.columns)} != {sorted(names)}"
    if mine != theirs:
        only_mine, only_theirs = set(mine) - set(theirs), set(theirs) - set(mine)
        return len(mine), (
            f"rows {len(mine)} / {len(theirs)}, differing {len(only_mine)} / {len(only_theirs)}: "
            f"{sorted(map(str, only_mine))[:2]} {sorted(map(str, only_theirs))[:2]}"
        )
    return len(mine), ""


if __name__ == "__main__":
    from breathline.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:] or list(entry_points.queries())
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for query_name in wanted:
        began = time.time()
        try:
            count, problem = differences(session, connection, sf_dir, query_name)
        except Exception as error:  # report and go on with the next query
            count, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {query_name:28} {count:7} rows {time.time() - began:6.1f}s {problem}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")

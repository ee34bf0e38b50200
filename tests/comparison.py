"""Run registered queries beside their SQL twins and compare whole results.

``python tests/comparison.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import collections
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayframe.plans.proxies import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _multiset(table) -> collections.Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return collections.Counter(repr(row) for row in zip(*columns))


def differences(frame, con, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result; empty when nothing does."""
    ours = frame.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"]
    out = []
    for name in ours.column_names:
        a, b = ours.schema.field(name).type, theirs.schema.field(name).type
        if str(a).removeprefix("large_") != str(b).removeprefix("large_"):
            out.append(f"type of {name}: {a} != {b}")
    if ours.num_rows != theirs.num_rows:
        out.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    left, right = _multiset(ours), _multiset(theirs)
    if left != right:
        out.append(f"only ours {list((left - right).elements())[:3]}")
        out.append(f"only theirs {list((right - left).elements())[:3]}")
    elif ours.num_rows == 0:
        out.append("empty result")
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from wayframe.plans.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in oracles:
                found = differences(frame, con, oracles[name])
            else:
                found = [] if frame.count() else ["empty result"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        failed += bool(found)
        state = "FAIL" if found else ("ok" if name in oracles else "ok (rows only)")
        print(f"{state:5} {name} {time.time() - start:.1f}s", *found, sep="\n    ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

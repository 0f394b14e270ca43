"""Run registered queries next to their DuckDB text and compare.

``python -m checks.compare [sf_dir] [key ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types and rows (as a multiset)."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if _SPARK_TYPES.get(kind) != types[name] and types[name] not in ('"NULL"', "NULL"):
            problems.append(f"type of {name}: {kind} != {types[name]}")
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, result.fetchall())
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        problems.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(only.values())} only "
            f"ours {list(only)[:2]}, {sum(missing.values())} only theirs {list(missing)[:2]}"
        )
    return problems


def main(argv: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from tallygrove.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    spark = local_session(8)
    con = connect(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in ORACLE:
                problems = compare(df, con, ORACLE[key])
                label = "ok" if not problems else "DIFF"
            else:
                problems, label = [], f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            problems, label = [str(error)[:1500]], "ERROR"
        bad += bool(problems)
        print(f"{label:8s} {key:28s} {time.time() - start:6.2f}s", *problems, sep="  ", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} fine; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

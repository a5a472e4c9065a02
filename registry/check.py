"""Run registered queries in Spark and DuckDB and compare the rows.

    python -m registry.check [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows) -> Counter:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in at) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] != right[1]:
        only_left, only_right = left[1] - right[1], right[1] - left[1]
        return (
            f"rows {sum(left[1].values())} != {sum(right[1].values())};"
            f" only spark {sum(only_left.values())}: {list(only_left)[:2]!r};"
            f" only sql {sum(only_right.values())}: {list(only_right)[:2]!r}"
        )
    return None


def main() -> int:
    from mediacat.session import build
    from registry import ORACLES, QUERIES, load

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load()
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = build("local[8]", 8), duck(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            got = spark_rows(QUERIES[name](spark, sf_dir))
            middle = time.time()
            message = "rows only" if name not in ORACLES else difference(got, duck_rows(con, ORACLES[name]))
        except Exception as error:  # report and go on with the next query
            middle, message = time.time(), f"{type(error).__name__}: {str(error)[:700]}"
        n = sum(got[1].values()) if message in (None, "rows only") else -1
        bad += message not in (None, "rows only")
        print(f"{name:30} {n:8} spark {middle - started:6.2f}s sql {time.time() - middle:6.2f}s {message or 'ok'}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() != 0)

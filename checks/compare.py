"""Run queries and their SQL counterparts on one data set and compare whole results.

    python -m checks.compare [data directory] [name prefix ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.queries import ORACLES, QUERIES
from fraudspark.plans.session import builder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    return str(v)


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """Null if equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if mine else "no rows"
    relation = con.sql(ORACLES[name])
    theirs = _sorted_rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ("no rows" if not mine else None)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = (
        builder("compare").master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())

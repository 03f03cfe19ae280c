"""Run registered queries against their SQL: python -m tests.check_queries [sf] [name ...]"""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from lendspark.session import build_session
from tests.oracle import connect, differences


def main(sf: str = "0.01", *names: str) -> int:
    spark = build_session(
        master="local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = f"/root/testdata/sf{sf}"
    db = connect(path)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, path)
            found = differences(df, db, oracles[name]) if name in oracles else [] if df.count() else ["empty"]
        except Exception as problem:  # report and go on with the next query
            found = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.2f}s", *found, sep="\n    ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

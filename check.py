"""Run registered queries against their SQL: ``python check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from revloom import build_session  # noqa: E402
from revloom.plans import catalog  # noqa: E402
from tests import oracle  # noqa: E402


def main(sf="/root/testdata/sf0.01", *names):
    spark = build_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf)
    queries, sql = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in sql:
                problem = oracle.compare(df, con, sql[name])
                note = "ok" if problem is None else f"DIFF {problem}"
                bad += problem is not None
            else:
                note = f"rows only: {len(df.collect())}"
        except Exception as error:  # keep going, report all
            note, bad = f"ERROR {str(error)[:1500]}", bad + 1
        print(f"{name:24s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)

"""Compares registered queries with their SQL: python tests/run_checks.py [sf_dir] [name ...]"""

import os
import sys
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from cratedig import session  # noqa: E402
from tests import harness  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = session.build(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con, checks, bad = harness.duck(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if args and not any(a in name for a in args):
            continue
        try:
            res, took = harness.compare(spark, con, name, fn, checks.get(name), sf_dir)
        except Exception as exc:  # report and go on
            res, took = "ERROR " + str(exc)[:600], 0.0
            if args:
                traceback.print_exc()
        good = res.startswith(("ok", "rows"))
        bad += not good
        print(f"{'  ' if good else '!!'} {name:32s} {took:6.2f}s {res}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())

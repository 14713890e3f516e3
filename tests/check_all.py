"""Run every registered query against its SQL: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from scoreloom.session import get_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session(
        master="local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = differences(queries[name](spark, sf_dir), con, sql[name])
        except Exception:
            problem = traceback.format_exc(limit=-3)[:1500]
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

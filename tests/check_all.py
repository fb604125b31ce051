"""Run every query against its SQL: ``python tests/check_all.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from workloads import QUERIES, SQL  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        began = time.time()
        try:
            if name in SQL:
                problems = compare(spark, con, QUERIES[name], SQL[name], folder)
            else:
                problems = [] if QUERIES[name](spark, folder).count() >= 0 else ["?"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += bool(problems)
        state = "FAIL" if problems else ("ok" if name in SQL else "ok (rows only)")
        print(f"{name:32s} {time.time() - began:6.2f}s {state}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
    return failed


if __name__ == "__main__":
    sys.exit(main())

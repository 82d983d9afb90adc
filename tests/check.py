"""Compare all (or the named) registered queries with their twins: check.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.compare import compare, connect  # noqa: E402
from tidewatch.session import get_spark  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_spark("check", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    twins = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in twins:
                problem, n = compare(df, twins[name], con)
                status = "ok" if not problem else "DIFF " + problem
            else:
                n, status = len(df.collect()), "rows-only"
        except Exception as e:  # report and go on
            n, status = 0, "ERROR " + str(e)[:1500]
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name:34s} {time.time() - start:6.2f}s {n:8d} {status}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(main())

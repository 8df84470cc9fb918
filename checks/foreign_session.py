"""Run the registered queries the way an outside driver does: the entry file
is loaded by path from another working directory, with a default session
(default shuffle partitions, no library session settings), and each result
is compared with its DuckDB oracle.

    cd /tmp && python /root/repo/checks/foreign_session.py [sf_dir] [name ...]
"""

from __future__ import annotations

import importlib.util
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spec = importlib.util.spec_from_file_location("__spark_entry__", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)

    from pyspark.sql import SparkSession

    from checks.compare import digest, duck

    spark = SparkSession.builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    t = time.time()
    df = entry.entry(spark)
    print("entry", df.count(), df.columns, round(time.time() - t, 1), flush=True)
    con = duck(sf)
    bad = []
    for name in sys.argv[2:] or sorted(entry.queries()):
        t = time.time()
        df = entry.queries()[name](spark, sf)
        rows = [tuple(r) for r in df.collect()]
        res = con.execute(entry.oracle_sql()[name])
        ok = digest(df.columns, rows) == digest([d[0] for d in res.description], res.fetchall())
        print(name, ok, len(rows), round(time.time() - t, 1), flush=True)
        if not ok:
            bad.append(name)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()

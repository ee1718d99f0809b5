"""CLI: compare every registered query with its oracle.

Usage: python tests/run_oracle.py [--plain] [sf_dir] [names...]
``--plain`` uses a session with Spark's defaults (200 shuffle partitions, no checkpoint
folder set), as a foreign driver might."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from rankfold.session import get_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    plain = "--plain" in args
    args = [a for a in args if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    if plain:
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]")
    qs, orc = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            r = compare(spark, qs, orc, name, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:400]}"}
        r["sec"] = round(time.time() - t, 2)
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(json.dumps(r, default=str), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

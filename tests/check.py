"""python tests/check.py [sf folder] [name part ...]: compare registered queries by hand."""

import sys
import time
import traceback

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from compare import database, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from outledger.session import tuned  # noqa: E402

folder, parts = sys.argv[1], sys.argv[2:]
spark = tuned(
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.driver.memory", "8g")
).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
con = database(folder)
queries, oracles = entry.queries(), entry.oracle_sql()
bad = 0
for name in queries:
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        df = queries[name](spark, folder)
        if name in oracles:
            result = difference(df, con, oracles[name]) or "ok"
        else:
            result = f"rows {df.count()} (no check SQL)"
    except Exception as error:  # noqa: BLE001
        result = f"ERROR {str(error)[:700]}"
        if "--trace" in sys.argv:
            traceback.print_exc()
    flag = "" if result == "ok" or "no check" in result else "  <<<<<<"
    bad += bool(flag)
    print(f"{name:28s} {time.time() - start:6.2f}s {result}{flag}", flush=True)
print("failures:", bad)

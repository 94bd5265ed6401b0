"""Compare registered queries with their SQL: ``python tests/check_queries.py [sf] [name …]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

import __spark_entry__ as contract
from compare import connect, mismatch

sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
names = sys.argv[2:]
sf_dir = f"/root/testdata/{sf}"
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "12g")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
connection = connect(sf_dir)
queries, sql = contract.queries(), contract.oracle_sql()
bad = 0
for name in names or queries:
    start = time.time()
    try:
        if name not in sql:
            problem = f"no sql; {queries[name](spark, sf_dir).count()} rows"
        else:
            problem = mismatch(queries[name](spark, sf_dir), connection, sql[name])
    except Exception as error:
        problem = f"{type(error).__name__}: {str(error)[:600]}"
    bad += problem is not None
    print(f"{name:32} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
print(f"{bad} of {len(names or queries)} differ")

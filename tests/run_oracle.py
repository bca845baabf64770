"""Compare all or some named queries at one data folder, with times: run_oracle.py FOLDER [NAME...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from compare import differences, duck  # noqa: E402

folder, names = sys.argv[1], sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.driver.memory", "16g")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = duck(folder)
sql = entry.oracle_sql()
for name, query in entry.queries().items():
    if name not in sql or names and name not in names:
        continue
    start = time.time()
    try:
        found = differences(query(spark, folder), con, sql[name])
    except Exception as error:  # show and go on with the next query
        found = [f"{type(error).__name__}: {str(error)[:700]}"]
    print(f"{name} {time.time() - start:.2f}s {found or 'ok'}", flush=True)

"""Compare catalog queries with their SQL: python tests/check_all.py SF_DIR [name …]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
from compare import connect, difference
from pyspark.sql import SparkSession


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            state = difference(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:
            state = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s  {state or 'ok'}", flush=True)


if __name__ == "__main__":
    main()

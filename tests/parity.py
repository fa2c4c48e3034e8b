"""Run all queries against DuckDB: python tests/parity.py [folder] [name...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, difference  # noqa: E402

from millrace.catalog import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402


def main(folder, names):
    spark = build_session(
        "parity", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or QUERIES:
        q = QUERIES[name]
        start = time.time()
        try:
            df = q(spark, folder)
            found = difference(df, con, q.sql) if q.sql else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:600]}"
        if found and not found.startswith("rows only"):
            bad += 1
        print(f"{time.time() - start:6.2f}s {name}: {found or 'ok'}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])

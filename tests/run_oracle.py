"""Run all or some registered queries against their reference SQL.

    python tests/run_oracle.py /root/testdata/sf0.01 [query …]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle_compare import connect, differences  # noqa: E402

import __spark_entry__ as registered  # noqa: E402
from voltseries.session import build_session  # noqa: E402


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
         "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = registered.oracle_sql()
    bad = 0
    for name, build in registered.queries().items():
        if name not in sql or names and name not in names:
            continue
        start = time.time()
        try:
            found = differences(build(spark, folder), con, sql[name])
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.2f}s", flush=True)
        for line in found:
            print("    ", line, flush=True)
        bad += bool(found)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

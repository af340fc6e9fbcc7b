"""Compare all registered queries with DuckDB: python tests/verify.py <sf_dir> [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from compare import differences  # noqa: E402
from conftest import session  # noqa: E402

import __spark_entry__ as driver  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = session()
    failed = 0
    for name in names or list(driver.queries()):
        start = time.time()
        try:
            if name in driver.oracle_sql():
                problem = differences(spark, sf_dir, name)
            else:
                problem = None if driver.queries()[name](spark, sf_dir).collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        if problem:
            print("     ", problem[:1500])
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

"""Run registered queries against their SQL: ``python tests/check_queries.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparkzone.queries import QUERIES, SQL  # noqa: E402
from sparkzone.session import build_session  # noqa: E402
from tests.oracle import compare_rows, connect  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    names = [n for n in QUERIES if any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in names)]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        start, took = time.time(), 0.0
        try:
            df = QUERIES[name](spark, folder)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            problem = compare_rows(df.columns, rows, con, SQL[name]) if name in SQL else f"rows={len(rows)} (no SQL)"
        except Exception as error:  # noqa: BLE001
            problem = f"ERROR {type(error).__name__}: {str(error)[:1200]}"
        bad = problem is not None and "(no SQL)" not in problem
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {took:.1f}s + sql {time.time() - start - took:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())

"""Run queries against the SQL checks: python tools/check.py [sf] [key-prefix ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larkspur.registry import callables, check_sql  # noqa: E402
from larkspur.session import build_session  # noqa: E402
from tests.compare import compare_one, open_tables  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(8)
    con = open_tables(folder)
    sqls = check_sql()
    bad = 0
    for key, fn in callables().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem, rows = compare_one(spark, con, fn, sqls.get(key), folder)
        except Exception as exc:  # report and go on with the next query
            problem, rows = f"{type(exc).__name__}: {str(exc)[:700]}", -1
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok  " if key in sqls else "rows")
        print(f"{mark} {key} rows={rows} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failures", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

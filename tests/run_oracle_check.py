"""Run every registered query against its DuckDB oracle; print one line per query.

    python tests/run_oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from claimweave.session import local_session
    spark = local_session(cores=8, shuffle_partitions=8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            got = fn(spark, sf).toArrow()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        sql = sqls.get(name)
        if sql is None:
            print(f"ROWS {name}: {got.num_rows} rows ({dt:.1f}s, no oracle)")
            continue
        try:
            exp = con.sql(sql).to_arrow_table()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        probs = compare(got, exp)
        if probs:
            bad += 1
            print(f"FAIL {name}: {'; '.join(probs)[:600]}")
        else:
            print(f"OK   {name}: {got.num_rows} rows ({dt:.1f}s)")
    spark.stop()
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

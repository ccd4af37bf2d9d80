"""Run every registered query against its DuckDB oracle at one scale factor.

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
"""

import json
import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from panelkit.plans import ORACLES, QUERIES  # noqa: E402
from panelkit.session import get_spark  # noqa: E402
from panelkit.testing import compare, duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    ok = bad = 0
    for name, fn in sorted(QUERIES.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        if name not in ORACLES:
            try:
                n = fn(spark, sf_dir).count()
                print(f"ROWS   {name}: {n} rows ({time.time() - t0:.1f}s)")
            except Exception:  # noqa: BLE001
                bad += 1
                print(f"ERROR  {name}\n{traceback.format_exc()[-1500:]}")
            continue
        try:
            r = compare(spark, name, sf_dir, fn, ORACLES[name], con)
        except Exception:  # noqa: BLE001
            bad += 1
            print(f"ERROR  {name}\n{traceback.format_exc()[-1500:]}")
            continue
        dt = time.time() - t0
        if r["exact"] and not r["types_match"]:
            bad += 1
            print(f"TYPES  {name}: {r['type_diff']}")
        elif r["exact"]:
            ok += 1
            print(f"OK     {name}: {r['spark_rows']} rows ({dt:.1f}s)")
        else:
            bad += 1
            r.pop("spark_cols") if r["cols_match"] else None
            print(f"DIFF   {name}: {json.dumps(r, default=str)[:1500]}")
    print(f"== {ok} ok, {bad} not ok")


if __name__ == "__main__":
    main()

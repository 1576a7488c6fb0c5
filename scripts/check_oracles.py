"""Check registered queries against their oracle SQL: python scripts/check_oracles.py [sf_dir] [name-prefix ...]"""

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from riskweave.plans.oracle import check  # noqa: E402
from riskweave.plans.registry import load_all  # noqa: E402
from riskweave.session import local_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
prefixes = sys.argv[2:]
spark = local_session(8)
bad = 0
for name in sorted(load_all()):
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    t0 = time.time()
    try:
        ok, msg = check(spark, name, sf_dir)
    except Exception as exc:  # report and continue
        ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        traceback.print_exc(limit=2)
    bad += not ok
    print(f"{'PASS' if ok else 'FAIL'} {name:32s} {time.time() - t0:6.2f}s {msg[:400]}", flush=True)
print("failures:", bad)

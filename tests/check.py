"""python tests/check.py [sf_dir] [name ...]: compare registered queries with their SQL."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kinetable.plans import ORACLES, QUERIES, load_all  # noqa: E402
from kinetable.session import local_session  # noqa: E402
from tests.harness import compare, connect  # noqa: E402

if __name__ == "__main__":
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    load_all()
    spark = local_session("check", 8)
    con = connect(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                diff = compare(spark, con, sf_dir, name, fn, ORACLES[name])
            else:
                diff = "" if fn(spark, sf_dir).count() else "no rows"
        except Exception as exc:  # report and go on
            diff = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(diff)
        print(f"{'ok  ' if not diff else 'FAIL'} {name} {time.time() - start:.2f}s {'' if name in ORACLES else '(rows only)'} {diff}", flush=True)
    print("failed:", bad)

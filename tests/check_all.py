"""Run registered queries against their SQL: python tests/check_all.py [sf_dir] [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_module  # noqa: E402
from oracle import connect, differences  # noqa: E402

from curvelake.session import local_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(entry_module.queries())
spark, con = local_session(8), connect(sf_dir)
queries, oracles = entry_module.queries(), entry_module.oracle_sql()
failed = 0
for name in names:
    start = time.time()
    try:
        got = queries[name](spark, sf_dir).toPandas()
        seconds = time.time() - start
        problem = differences(got, con.execute(oracles[name]).df()) if name in oracles else None
    except Exception as e:  # report and go on with the next query
        seconds, problem, got = time.time() - start, "".join(traceback.format_exception_only(e))[:1500], []
    failed += problem is not None
    mark = "FAIL" if problem else ("ok  " if name in oracles else "rows")
    print(f"{mark} {name:32s} {seconds:6.2f}s {len(got):7d} rows {problem or ''}", flush=True)
print("failed:", failed)

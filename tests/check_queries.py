"""Command line: compare the named (or all) queries with their SQL and time them.

    python tests/check_queries.py [--sf sf0.01] [name ...]
"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402
from newstide.session import build_session  # noqa: E402

args = sys.argv[1:]
sf = args.pop(args.index("--sf") + 1) if "--sf" in args else "sf0.01"
names = [a for a in args if a != "--sf"]
sf_dir = f"/root/testdata/{sf}"
spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                      spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
sqls = entry.oracle_sql()
bad = []
for name, fn in entry.queries().items():
    if names and name not in names:
        continue
    start = time.time()
    try:
        df = fn(spark, sf_dir)
        if name in sqls:
            diff = differences(df, con, sqls[name])
            note = diff or "ok"
        else:
            diff, note = None, f"rows {df.count()} (no SQL)"
    except Exception as e:  # noqa: BLE001
        diff = note = f"{type(e).__name__}: {str(e)[:600]}"
    if diff:
        bad.append(name)
    print(f"{time.time() - start:7.2f}s {name:28s} {note}", flush=True)
unknown = set(sqls) - set(entry.queries())
print("bad:", bad, "| sql without query:", sorted(unknown))

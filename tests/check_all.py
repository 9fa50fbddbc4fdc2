"""Run every named query and its SQL side by side: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_compare as oc  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402

from tillwatch.session import spark_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2:]
spark = spark_session("check", "local[8]", spark__sql__shuffle__partitions="8",
                      spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
spark.sparkContext.setLogLevel("ERROR")
if os.environ.get("CHECK_TZ"):
    spark.conf.set("spark.sql.session.timeZone", os.environ["CHECK_TZ"])
con = oc.connect(sf)
oracles = oracle_sql()
bad = []
for name, query in queries().items():
    if only and name not in only:
        continue
    try:
        began = time.time()
        df = query(spark, sf)
        cols, got = oc.spark_rows(df)
        took = time.time() - began
        if name not in oracles:
            print(f"{name:28s} {took:6.2f}s rows={sum(got.values())} no oracle")
            continue
        want_cols, want = oc.duck_rows(con, oracles[name])
        notes = oc.type_differences(df, con, oracles[name])
        ok = cols == want_cols and got == want
        print(f"{name:28s} {took:6.2f}s rows={sum(got.values())} {'ok' if ok else 'DIFFERS'} {notes or ''}",
              flush=True)
        if not ok:
            bad.append(name)
            if cols != want_cols:
                print("   columns", cols, want_cols)
            print("   only spark", list((got - want).items())[:3])
            print("   only duck ", list((want - got).items())[:3])
    except Exception as exc:  # noqa: BLE001
        bad.append(name)
        print(f"{name:28s} FAILED {str(exc)[:900]}", flush=True)
print("bad:", bad)

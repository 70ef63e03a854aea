"""All eight collections, in load order, from the nested fixture collections of one
scale factor into a fresh store in the shared checkpoint folder; then every collection's
validation report (length checks left out). usage: python tools/full_migration.py [sf_dir]
"""
import os, sys, time, uuid
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from docnorm.session import local_session, ensure_checkpoint_dir
from docnorm.plans import load as L
from docnorm.sources import nest
from pyspark.sql import functions as F
spark = local_session("8", 8)
d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
store = L.Store(spark, os.path.join(ensure_checkpoint_dir(spark), "full-run", uuid.uuid4().hex))
run = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
src = {"users": "users", "usersgroups": "orders", "listbuilder": "listbuilder", "formbuilder": "formbuilder",
       "processtypes": "processtypes", "processes": "orders", "people": "people", "documents": "orders"}
t0 = time.time()
for name in L.load_order():
    t = time.time()
    out = L.load_collection(spark, name, nest.docs(spark, d, src[name]), store, run)
    rows = {r["table"].split(".")[-1]: r["rows"] for r in out.collect()}
    print(f"{name:14s} {time.time()-t:6.1f}s", rows)
print("total", round(time.time()-t0, 1))
bad = 0
for name in L.load_order():
    v = L.validate_collection(store, name).where("violations > 0 and check != 'length'")
    for r in v.collect():
        print("  violation", name, r["table"], r["check"], r["column"], r["violations"]); bad += 1
print("violations", bad)

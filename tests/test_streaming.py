"""Incremental micro-batch load: two files arrive as two batches; replays are no-ops."""
import json
import os
import tempfile

from pyspark.sql import functions as F

from docnorm.plans import load as L
from docnorm.streaming.batches import stream_collection


def test_micro_batches_merge_users(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    store = L.Store(spark, tempfile.mkdtemp(prefix="stream-store-"))
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    docs1 = [{"_id": "u00001", "firstname": "A", "lastname": "B", "email": "a@x", "role": {"id": "r1", "name": "R1"}},
             {"_id": "u00002", "firstname": "C", "lastname": "D", "email": "c@x"}]
    docs2 = [{"_id": "u00001", "firstname": "Changed", "lastname": "B", "email": "a@x", "role": {"id": "r1", "name": "R1b"}},
             {"_id": "u00003", "firstname": "E", "lastname": "F", "email": "e@x"}]
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join(json.dumps(d) for d in docs1) + "\n")
    stream_collection(spark, src, "users", store, checkpoint=ckpt, max_files_per_trigger=1, check_parents=False)
    with open(os.path.join(src, "b.json"), "w") as fh:
        fh.write("\n".join(json.dumps(d) for d in docs2) + "\n")
    stream_collection(spark, src, "users", store, checkpoint=ckpt, max_files_per_trigger=1, check_parents=False)
    main = {r["id"]: r["firstname"] for r in store.read("lml_users", "main").collect()}
    assert main == {"u00001": "A", "u00002": "C", "u00003": "E"}   # users.main is first-wins
    roles = {r["id"]: r["name"] for r in store.read("lml_users", "roles").collect()}
    assert roles == {"r1": "R1b"}                                    # catalogs are last-wins


def test_micro_batches_keep_main_and_children_of_a_document_together(spark):
    src = tempfile.mkdtemp(prefix="stream-src-")
    store = L.Store(spark, tempfile.mkdtemp(prefix="stream-store-"))
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    users = [{"_id": "user01", "firstname": "A", "lastname": "B", "email": "a@x"}]
    with open(os.path.join(src, "u.json"), "w") as fh:
        fh.write(json.dumps(users[0]) + "\n")
    stream_collection(spark, src, "users", store, checkpoint=ckpt, check_parents=False)
    psrc = tempfile.mkdtemp(prefix="stream-proc-")
    pckpt = tempfile.mkdtemp(prefix="stream-pckpt-")
    p1 = {"_id": "p1", "createdBy": {"user": "user01"}, "movements": [{"id": "a", "to": "x"}, {"id": "b", "to": "y"}]}
    p2 = {"_id": "p2", "movements": [{"id": "c", "to": "z"}]}
    with open(os.path.join(psrc, "a.json"), "w") as fh:
        fh.write(json.dumps(p1) + "\n" + json.dumps(p2) + "\n")
    stream_collection(spark, psrc, "processes", store, checkpoint=pckpt, max_files_per_trigger=1, check_parents=False)
    p1b = {"_id": "p1", "movements": [{"id": "d", "to": "w"}]}
    with open(os.path.join(psrc, "b.json"), "w") as fh:
        fh.write(json.dumps(p1b) + "\n")
    stream_collection(spark, psrc, "processes", store, checkpoint=pckpt, max_files_per_trigger=1, check_parents=False)
    moves = sorted((r["process_id"], r["destination_id"]) for r in store.read("lml_processes", "movements").collect())
    # processes are first-wins: the main row of p1 stays, and so do its children
    assert moves == [("p1", "a"), ("p1", "b"), ("p2", "c")]
    main = {r["process_id"]: r["created_by_user_id"] for r in store.read("lml_processes", "main").collect()}
    assert main == {"p1": "user01", "p2": None}                   # main is first-wins

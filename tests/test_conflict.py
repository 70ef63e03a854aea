"""Key-conflict policies (U1–U8): FIXTURES §2 rows 16, 18–20."""
from pyspark.sql import functions as F

from docnorm.operators import conflict as U

from helpers import rows


def df(spark, data, schema="id string, name string, _seq long"):
    return spark.createDataFrame(data, schema)


def test_last_and_first_wins(spark):
    d = df(spark, [("a", "x", 0), ("a", "y", 1), ("b", "z", 2)])
    assert sorted(rows(U.dedupe(d, "id", keep="last"), "id", "name")) == [("a", "y"), ("b", "z")]
    assert sorted(rows(U.dedupe(d, "id", keep="first"), "id", "name")) == [("a", "x"), ("b", "z")]


def test_batched_first_wins(spark):
    d = df(spark, [("a", "b0-first", 0), ("a", "b0-last", 1), ("a", "b1", 2)])
    assert rows(U.dedupe(d, "id", batch_size=2), "name") == [("b0-last",)]


def test_null_keys_never_conflict(spark):
    d = spark.createDataFrame([("p", None, 0), ("p", None, 1), ("p", "f", 2), ("p", "f", 3)],
                              "pid string, fid string, _seq long")
    out = U.dedupe(d, ["pid", "fid"], keep="first")
    assert sorted(rows(out, "fid", "_seq"), key=str) == sorted([(None, 0), (None, 1), ("f", 2)], key=str)


def test_strict_insert_rejects(spark):
    d = spark.createDataFrame([("p", "d1", 0, 0), ("p", "d1", 0, 1), ("p", "d2", 0, 2)],
                              "pid string, did string, _seq long, pos long")
    acc, rej = U.strict_insert(d, ["pid", "did"], order=["_seq", "pos"])
    assert sorted(rows(acc, "did", "pos")) == [("d1", 0), ("d2", 2)]
    assert rows(rej, "did", "pos", "reject_reason") == [("d1", 1, "duplicate_key")]


def test_upsert_policies(spark):
    target = spark.createDataFrame([("a", "old"), ("c", "keep")], "id string, name string")
    inc = df(spark, [("a", "new", 0), ("b", "b", 1)])
    assert sorted(rows(U.upsert(target, inc, "id", "last"))) == [("a", "new"), ("b", "b"), ("c", "keep")]
    assert sorted(rows(U.upsert(target, inc, "id", "first"))) == [("a", "old"), ("b", "b"), ("c", "keep")]


def test_sync_members(spark):
    target = spark.createDataFrame([("g1", "u1"), ("g1", "u2"), ("g2", "u3"), ("g3", "u9")], "group_id string, user_id string")
    inc = spark.createDataFrame([("g1", "u4")], "group_id string, user_id string")
    present = spark.createDataFrame([("g1",), ("g2",)], "group_id string")
    assert sorted(rows(U.sync_members(target, inc, "group_id", present))) == [("g1", "u4"), ("g3", "u9")]


def test_refresh_closure():
    edges = [("s.child", "s.main"), ("s.main", "u.main"), ("u.main", "u.roles"), ("g.members", "u.main")]
    assert sorted(U.refresh_closure(edges, "u.main")) == ["g.members", "s.child", "s.main", "u.main"]


def test_dedupe_is_partial_aggregate(spark):
    d = df(spark, [("a", "x", 0)])
    plan = U.dedupe(d, "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "HashAggregate" in plan


def test_upsert_null_keys_never_conflict(spark):
    target = spark.createDataFrame([(None, "t-null"), ("a", "old")], "id string, name string")
    inc = df(spark, [(None, "i-null", 0), ("a", "new", 1)])
    assert sorted(rows(U.upsert(target, inc, "id", "last")), key=str) == sorted(
        [(None, "t-null"), (None, "i-null"), ("a", "new")], key=str)
    assert sorted(rows(U.upsert(target, inc, "id", "first")), key=str) == sorted(
        [(None, "t-null"), (None, "i-null"), ("a", "old")], key=str)

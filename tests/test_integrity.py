"""Referential integrity and ghost parents (J1–J4, R1–R5): FIXTURES §2 rows 13–17."""
from pyspark.sql import functions as F

from docnorm.operators import integrity as R

from helpers import rows


def users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_snapshot_user_forms(docs, spark):
    d = docs({"createdBy": {"user": "abcdef1"}}, {"createdBy": {"user": 1234567}},
             {"createdBy": {"user": {"_id": {"$oid": "oid00001"}, "firstName": "F"}}},
             {"createdBy": {"user": {"id": "abcd"}}}, {"createdBy": {}}, {"createdBy": {"user": False}})
    s = R.snapshots(d, paths=("createdBy",))
    got = sorted(rows(s, "_seq", "id", "firstname"))
    assert got == [(0, "abcdef1", None), (1, "1234567", None), (2, "oid00001", "F")]


def test_ghost_first_snapshot_wins(docs, spark):
    d = docs({"createdBy": {"user": {"id": "ghost1", "firstname": "First"}}},
             {"createdBy": {"user": {"id": "ghost1", "firstname": "Second"}}},
             {"createdBy": {"user": {"id": "known1", "firstname": "K"}}})
    g = R.ghost_users(d, users(spark, "known1"))
    assert rows(g, "id", "firstname", "lastname", "deleted") == [("ghost1", "First", "User", True)]


def test_ghost_processtypes_defaults(docs, spark):
    d = docs({"createdBy": {"user": {"id": "p1"}}}, {"createdBy": {"user": "string-user"}})
    g = R.ghost_users(d, users(spark), flavour="processtypes")
    assert rows(g, "id", "firstname", "lastname", "email") == [("p1", "Ghost", "User", "p1@ghost.local")]


def test_ghost_groups_no_camelcase(docs, spark):
    d = docs({"createdBy": {"user": {"id": "grp0001", "firstName": "Camel"}}})
    g = R.ghost_users(d, users(spark), flavour="groups")
    assert rows(g, "firstname") == [("Restored",)]


def test_semi_null_anti(spark):
    child = spark.createDataFrame([("a", "r1"), ("b", "r9"), ("c", None)], "k string, role string")
    parent = spark.createDataFrame([("r1",)], "id string")
    assert sorted(rows(R.keep_if_parent(child, "role", parent, "id"), "k")) == [("a",)]
    assert sorted(rows(R.null_if_orphan(child, "role", parent, "id"), "k", "role")) == [
        ("a", "r1"), ("b", None), ("c", None)]
    assert rows(R.orphans(child, "role", parent, "id"), "k") == [("b",)]


def test_members_with_ghosts(docs, spark):
    d = docs({"createdBy": {"user": {"id": "ghost01"}}})
    g = R.ghost_users(d, users(spark, "user001"))
    valid = R.valid_parents(users(spark, "user001"), g)
    members = spark.createDataFrame([("g", "ghost01"), ("g", "user001"), ("g", "nobody1"), ("g", "")],
                                    "group_id string, user_id string")
    assert sorted(rows(R.keep_if_parent(members, "user_id", valid, "id"), "user_id")) == [("ghost01",), ("user001",)]


def test_dependency_check_and_order(spark):
    rep = R.dependency_check({"users": users(spark, "a"), "processtypes": users(spark)})
    assert sorted(rows(rep, "collection", "row_count", "ok")) == [("processtypes", 0, False), ("users", 1, True)]
    assert R.load_order({"processes": ("users", "processtypes"), "processtypes": ("users",), "users": ()}) == [
        "users", "processtypes", "processes"]


def test_ghost_plan_is_compact(docs, spark):
    d = docs({"createdBy": {"user": {"id": "ghost01"}}})
    plan = R.ghost_users(d, users(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 60000


def test_salted_joins_equal_plain(spark):
    child = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS k")
    parent = spark.createDataFrame([("hot",)] + [(str(i),) for i in range(0, 50, 2)], "id string")
    for salt in (1, 7):
        assert sorted(R.keep_if_parent(child, "k", parent, "id", salt=salt).collect()) == \
            sorted(R.keep_if_parent(child, "k", parent, "id").collect())
        assert sorted(R.orphans(child, "k", parent, "id", salt=salt).collect()) == \
            sorted(R.orphans(child, "k", parent, "id").collect())
        assert sorted(R.null_if_orphan(child, "k", parent, "id", salt=salt).collect()) == \
            sorted(R.null_if_orphan(child, "k", parent, "id").collect())


def test_load_order_detects_cycles():
    import pytest
    with pytest.raises(ValueError):
        R.load_order({"a": ("b",), "b": ("a",)})

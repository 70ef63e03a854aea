"""Rows, columns and values that nothing reads are not carried through shuffles or copied."""
from docnorm.functions import values as V
from docnorm.operators import conflict as U
from docnorm.operators import integrity as R
from docnorm.operators import validate as VAL
from docnorm.plans import collections as CL
from docnorm.plans import spec as S

ODD = [None, False, True, 0, 0.0, 7, 70000, "", "0", "0000001", "false", "true", "True", "[]", "{}", [], {}, [0], {"a": 1},
       {"$oid": "abcdef"}, {"$oid": ""}, "{x", "short", "abcd", "-0", -30000, 1.5, 12345.5, "u000001"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_audit_ids_equal_those_of_whole_snapshots(docs):  # F1
    users = [{"id": v} for v in ODD] + [{"_id": v} for v in ODD] + [{"id": "", "_id": v} for v in ODD] + ODD
    d = docs(*[{"createdBy": {"user": u}} for u in users], *[{"createdBy": v} for v in ODD], {}).cache()
    for flavour in R.FLAVOURS:
        got = R.with_audit_ids(d, {"cu": "createdBy"}, flavour)
        want = R.snapshot_users(d.withColumn("s", V.at("doc", "createdBy")), "s", flavour, keep=["_seq"])
        assert "_plain#" in optimized(got)
        assert [tuple(r) for r in got.select("_seq", "cu").orderBy("_seq").collect()] == \
            [tuple(r) for r in want.select("_seq", "id").orderBy("_seq").collect()]


def test_truth_of_mostly_scalars(docs):  # F3, F5 to F7
    rows = docs(*[{"v": v} for v in ODD], {}).select(
        "_seq", V.truthy_at("doc", "v").alias("got"), V.truthy(V.at("doc", "v")).alias("want")).orderBy("_seq").collect()
    assert [r.got for r in rows] == [r.want for r in rows] == [bool(v) for v in ODD] + [False]


def test_columns_of_the_order_are_shuffled_once(spark):  # F5, F7
    d = spark.createDataFrame([("a", "x", 5, 1), ("a", "y", 5, 0), (None, "z", 6, 0), (None, "z", 6, 1)],
                              "id string, name string, _seq long, pos long")
    df = U.dedupe(d, "id", keep="first", seq=["_seq", "pos"])
    assert sorted(map(tuple, df.collect()), key=str) == [("a", "y", 5, 0), (None, "z", 6, 0), (None, "z", 6, 1)]
    text = optimized(df.select("id", "name"))
    assert text.count("max_by(") == 1 and "_seq, _seq#" not in text.partition("max_by(")[2].partition("\n")[0]


def test_columns_that_nothing_reads_are_not_made(docs):  # F1, F3
    d = docs({"_id": "d1", "documentName": "first", "deleted": True}, {"_id": "d1", "documentName": "second"}, {"_id": "d2"})
    users = docs({"_id": "u"}).select(V.oid("doc").alias("id"))
    whole = S.normalise(CL.DOCUMENTS, d, users=users, only=["main"]).tables["main"]
    some = S.normalise(CL.DOCUMENTS, d, users=users, only=["main"], columns={"main": ["document_name"]}).tables["main"]
    assert some.columns == ["document_id", "document_name"]
    assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, whole.select(*some.columns).collect()), key=str)
    assert "documentContent" in optimized(whole) and "documentContent" not in optimized(some)


def test_columns_of_policies_and_parent_rules_stay(docs):  # F3
    members = S._narrowed(CL.USERSGROUPS.table("members"), ["group_id"])
    assert [c.name for c in members.cols] == ["group_id", "user_id"]
    assert S._narrowed(members, None) is members
    keys = CL.foreign_keys()
    assert VAL.key_columns("lml_processes.main", keys) == ["created_by_user_id", "updated_by_user_id", "process_id"]


def test_items_only_told_to_be_objects_are_not_copied(docs):  # F3
    d = docs({"_id": "p", "movements": [{"id": 1}, 2, None, {}, [3], "x"], "initiatorFields": {"a": {"id": 1}, "b": 2, "c": {}}})
    keys = CL.foreign_keys()
    for name, want in (("movements", [("p",)] * 2), ("initiator_fields", [("p", "a"), ("p", "c")])):
        df = S.normalise(CL.PROCESSES, d, only=[name], columns={name: VAL.key_columns(f"lml_processes.{name}", keys)}).tables[name]
        assert "StructType()" in optimized(df) and sorted(map(tuple, df.collect())) == want

"""Rules where an operator and its oracle could share a mistake: expected values by hand."""
import duckdb
from pyspark.sql import functions as F

from helpers import rows
from docnorm.operators import nested as N, profile as G
from docnorm.plans import collections as CL, oracle
from docnorm.plans.spec import normalise
from docnorm.sources import nest


def test_long_keys_keep_all_digits(spark):
    keys = [7, 1234567, 1234568, 99999999999]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k long").select(nest.uid(F.col("k"))).collect()]
    want = [duckdb.sql(f"SELECT {oracle._uid(str(k))}").fetchall()[0][0] for k in keys]
    assert got == want == ["u000007", "u1234567", "u1234568", "u99999999999"]
    assert spark.range(1).select(nest.uid(F.lit(None).cast("long"))).first()[0] is None


def test_next_workflow_needs_an_object_with_a_user(docs):
    d = docs({"_id": "d1", "lumbreNextSigner": {"role": {"id": "r"}}, "lumbreNextParticipant": "text",
              "lumbreNextReviewer": {"id": 0, "_id": {"$oid": "abc"}}},
             {"_id": "d2", "lumbreNextSigner": {"id": {"$oid": ""}}, "lumbreNextParticipant": {"id": "0"},
              "lumbreNextReviewer": {}},
             {"_id": "d3", "lumbreNextSigner": {"id": 17}, "lumbreNextParticipant": [1], "lumbreNextReviewer": None})
    t = normalise(CL.DOCUMENTS, d).tables["next_workflow"]
    assert sorted(rows(t, "document_id", "workflow_type", "user_id")) == [
        ("d1", "reviewer", "abc"), ("d2", "participant", "0"), ("d3", "signer", "17")]
    assert sorted(rows(N.unpivot_objects(d, {"s": "lumbreNextSigner", "p": "lumbreNextParticipant"}, keep=["_seq"]), "_seq", "tag")) == [
        (0, "s"), (1, "p"), (1, "s"), (2, "s")]


def test_missing_type_names_are_empty(spark, docs):
    d = docs({"_id": "t", "instanceStarters": {"peopleTypes": [{"id": "a"}, {"id": "b", "name": "B"}],
                                               "initiatorTypes": [{"id": "i"}, {"id": ""}, "x"]}})
    parents = {f"lml_users.{t}": spark.createDataFrame([], "id string") for t in ("areas", "subareas", "roles")}
    t = normalise(CL.PROCESSTYPES, d, parents=parents).tables
    assert sorted(rows(t["people_types"], "id", "name")) == [("a", ""), ("b", "B")]
    assert rows(t["initiator_types"], "id", "name") == [("i", "")]


def test_movement_names_of_missing_and_other_creators(docs):
    d = docs({"_id": "d", "movements": [{"created_by": {"firstname": "A", "lastname": "B"}}, {"created_by": None}, {"created_by": "x"}, {}]})
    t = normalise(CL.DOCUMENTS, d).tables["movements"]
    assert sorted(rows(t, "created_by_user_name"), key=str) == [("",), ("A B",), (None,), (None,)]


def test_membership_counts_groups_that_have_members(docs):
    d = docs({"users": ["a", "b"]}, {"users": []}, {"users": ["b"]}, {}, {"users": "x"})
    assert rows(G.membership_profile(d)) == [(2, 3, 2, 1, 2, 1.5)]


def test_coverage_is_exact_and_marks_dynamic_fields(docs):
    d = docs({"a": 1, "x_1": 0}, {"a": 2}, {"b": 1, "_id": 1})
    got = {r[0]: r[1:] for r in rows(G.field_coverage(d), "field", "present", "pct", "dynamic")}
    assert got == {"a": (2, 200 / 3, False), "x_1": (1, 100 / 3, True), "b": (1, 100 / 3, False), "_id": (1, 100 / 3, False)}
    assert sorted(rows(G.optional_fields(d), "field")) == [("_id",), ("a",), ("b",), ("x_1",)]


def test_examples_of_dynamic_fields_are_truthy(docs):
    d = docs({"x_1": 0}, {"x_1": "p"}, {"x_1": [1]}, {"x_1": "q"}, {"y_2": ""})
    assert sorted(rows(G.dynamic_detect(d), "field", "n", "examples"), key=str) == [("x_1", 4, "p | array[1]"), ("y_2", 1, None)]
    assert rows(G.field_examples(d, truthy_only=True), "field", "example") == [("x_1", "p"), ("x_1", "array[1]"), ("x_1", "q")]


def test_underscore_fields_count_each_nested_key(docs):
    d = docs({"_1": {"a": 1, "b": 2}}, {"_1": {"a": 0}}, {"_1": ""}, {"_1": None}, {"_2": 3, "_x": 1})
    assert sorted(rows(G.underscore_fields(d), "field", "n", "types")) == [("_1", 4, "null/empty,object"), ("_2", 1, "int")]
    assert sorted(rows(G.underscore_nested(d), "field", "nested_key", "n")) == [("_1", "a", 2), ("_1", "b", 1)]


def test_probe_counts_either_word(docs):
    d = docs({"CreatedBy": 1}, {"x": "User"}, {"x": "nobody"}, {"customerId": 1, "user": 2})
    assert sorted(rows(G.text_reference_probe(d), "word", "n")) == [("customer", 1), ("user", 3)]


def test_child_tables_by_average_length(docs):
    d = docs({"a": list(range(7)), "b": [1]}, {"a": list(range(5)), "b": "x"}, {"a": None})
    assert rows(G.child_table_candidates(d), "field", "avg_len") == [("a", 6.0)]


def test_generators_do_not_carry_the_document(docs):
    d = docs({"_id": "d", "movements": [{"movement": 1}]})
    plan = normalise(CL.DOCUMENTS, d).tables["movements"]._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "doc#" not in generate


def test_null_keys_go_round_the_parent_join(spark):
    child = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (4, None)], "id long, role string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "rid string")
    from docnorm.operators import integrity as R
    for salt in (1, 3):
        assert sorted(rows(R.null_if_orphan(child, "role", parent, "rid", salt=salt)), key=str) == [
            (1, "a"), (2, None), (3, None), (4, None)]


def test_a_missing_parent_table_is_an_error(docs):
    import pytest
    d = docs({"_id": "t", "instanceActions": {"area": [{"id": 1}]}})
    with pytest.raises(ValueError, match="parent table"):
        normalise(CL.PROCESSTYPES, d)


def test_loads_lose_nothing_in_silence(spark, docs, tmp_path):
    from docnorm.plans import load as L
    store = L.Store(spark, str(tmp_path))
    L.load_collection(spark, "users", docs({"_id": "u1"}), store)
    first = docs({"_id": "l1", "alias": "a", "fields": [{"key": "k1", "name": "n"}]})
    again = docs({"_id": "l1", "alias": "b", "fields": [{"key": "k2", "name": "n"}]}, {"_id": "l2", "alias": "c"})
    bad = spark.createDataFrame([(9, "{", "unparsable_json")], "_seq long, raw string, reject_reason string")
    L.load_collection(spark, "listbuilder", first, store, refresh=False)
    main = store.read("lml_listbuilder", "main")
    assert main.count() == 1
    out = L.load_collection(spark, "listbuilder", again, store, refresh=False, unparsed=bad)
    assert ("lml_listbuilder._rejects_documents", 1) in rows(out)
    got = dict(rows(store.read("lml_listbuilder", "main"), "listbuilder_id", "alias"))
    assert got == {"l1": "a", "l2": "c"}
    assert [r["reject_reason"] for r in store.read("lml_listbuilder", "_rejects_main").collect()] == ["duplicate_key"]
    fields = store.read("lml_listbuilder", "fields")
    assert fields.where("listbuilder_id = 'l1'").count() == 1 and fields.where("field_key = 'k2'").count() == 0
    L.load_collection(spark, "listbuilder", again, store, refresh=False)
    assert store.read("lml_listbuilder", "_rejects_main").count() == 3  # added, not replaced
    L.load_collection(spark, "users", docs({"_id": "u2"}), store)  # a refresh empties what refers to users
    assert store.read("lml_listbuilder", "main").count() == 0

"""Profiling (G1–G28) and validation (V1–V9) on small hand-made collections."""
from pyspark.sql import functions as F

from docnorm.operators import profile as G
from docnorm.operators import validate as VAL

from helpers import rows


def test_field_coverage(docs):
    d = docs({"a": 1, "b": None}, {"a": "x"}, {"c": []})
    got = {r["field"]: (r["present"], round(r["pct"], 2), r["nulls"], r["types"]) for r in G.field_coverage(d).collect()}
    assert got == {"a": (2, 66.67, 0, "integer,string"), "b": (1, 33.33, 1, "null"), "c": (1, 33.33, 0, "array")}


def test_examples_first_seen(docs):
    d = docs({"a": "z"}, {"a": "y"}, {"a": "z"}, {"a": "x"}, {"a": "w"})
    assert rows(G.field_examples(d).orderBy("rank"), "example") == [("z",), ("y",), ("x",)]


def test_array_profile_and_buckets(docs):
    d = docs({"users": ["a", "b"]}, {"users": []}, {"users": [str(i) for i in range(7)]})
    p = G.array_profile(d).first()
    assert (p["docs_with_array"], p["docs_with_data"], p["min_len"], p["max_len"]) == (3, 2, 0, 7)
    assert sorted(rows(G.membership_buckets(d))) == [("1-5", 1), ("6-10", 1)]


def test_structure_variants(docs):
    d = docs({"o": {"a": 1}}, {"o": {"a": 1, "b": 2}}, {"p": {"a": 1}})
    got = {r["field"]: r["variants"] for r in G.structure_variants(d).collect()}
    assert got == {"o": 2, "p": 1}


def test_validations(spark):
    t = spark.createDataFrame([("a", "xx", "1"), ("a", None, "zz"), (None, "yyyy", None)], "k string, s string, n string")
    assert rows(VAL.unique_violations(t, "k"), "k", "n") == [("a", 2)]
    assert sorted(rows(VAL.not_null_violations(t, ["k", "s"]))) == [("k", 1), ("s", 1)]
    assert rows(VAL.length_overflow(t, {"s": 3}), "violations") == [(1,)]
    assert rows(VAL.cast_failures(t, {"n": "int"}), "failures") == [(1,)]
    full = VAL.with_defaults(spark.createDataFrame([("g",)], "id string"), [("id", "string"), ("deleted", "boolean")],
                             {"deleted": True})
    assert rows(full) == [("g", True)]


def test_report_sections_run(docs):
    d = docs({"_id": "a", "users": ["x"], "createdBy": {"user": "abcdef"}, "campo_1": "v"},
             {"_id": "b", "users": [], "o": {"k": 1}})
    rep = G.report(d)
    assert set(rep) >= {"field_coverage", "schema_recommendation", "snapshot_profile"}
    for name, df in rep.items():
        df.collect()


def test_timestamp_examples_and_access_lists(docs):
    d = docs({"t": {"$date": "2021-01-01T00:00:00Z"}, "acc": ["a"]}, {"t": "2021-01-02T00:00:00Z", "acc": []},
             {"t": "2021-01-02T00:00:00Z"})
    row = G.timestamp_profile(d, ["t"], examples=2).first()
    assert row["present"] == 3 and row["formats"] == "iso_z,object_date"
    assert row["examples"] == '{"$date":"2021-01-01T00:00:00Z"} | "2021-01-02T00:00:00Z"'
    assert rows(G.access_list_docs(d, ["acc"])) == [("acc", 1)]


def test_cascade_over_a_graph(spark):
    """A chain of three, a row reached two ways, one that lost its reference, and NULL keys."""
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "leaf": frame([(1, 10, 1), (2, 20, 1), (3, 10, 2), (4, None, 2), (5, 99, None), (6, 30, 2)], "id int, mid int, tag int"),
        "mid": frame([(10, 1), (20, 2), (30, 3), (40, None)], "id int, top int"),
        "top": frame([(1, True), (2, False), (3, None)], "id int, old boolean"),
        "tag": frame([(1,), (2,)], "id int"),
    }
    references = [VAL.Reference("leaf", "mid", "mid", "id"), VAL.Reference("mid", "top", "top", "id"), VAL.Reference("leaf", "tag", "tag", "id", "set null")]
    left = VAL.cascade(tables, references, {"top": F.col("old"), "tag": F.col("id") == 1, "leaf": F.col("id") == 6})
    assert sorted(rows(left["top"], "id")) == [(2,), (3,)] and sorted(rows(left["mid"], "id")) == [(20,), (30,), (40,)]
    assert sorted(map(str, rows(left["leaf"]))) == ["(2, 20, None)", "(4, None, 2)", "(5, 99, None)"]
    assert rows(VAL.cascade(tables, references, {})["leaf"].orderBy("id")) == rows(tables["leaf"].orderBy("id"))


def test_foreign_keys_of_a_graph(spark):
    """NULLs refer to nothing, repeated orphans count each, an empty parent holds no key; one scan a child."""
    child = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), ("b", "y"), (None, None)], "p string, q string")
    tables = {"child": child, "one": spark.createDataFrame([("a",), (None,), ("a",)], "id string"),
              "two": spark.createDataFrame([], "id string"), "number": spark.createDataFrame([(1,), (2,)], "one int")}
    references = [VAL.Reference("child", "p", "one", "id"), VAL.Reference("child", "q", "two", "id"),
                  VAL.Reference("number", "one", "one", "id"), VAL.Reference("child", "p", "absent", "id")]
    found = VAL.fk_graph_violations(tables, references)
    assert sorted(map(tuple, found.collect())) == [("child", "p", "one", 2), ("child", "q", "two", 3), ("number", "one", "one", 2)]


def test_the_model_has_69_foreign_keys():
    from docnorm.plans import collections as CL
    keys = CL.foreign_keys()
    assert len(keys) == 69
    assert {(r.parent, r.on_delete) for r in keys if r.child == "lml_usersgroups.members"} == {
        ("lml_users.main", "cascade"), ("lml_usersgroups.main", "cascade")}
    for r in keys:
        for name, column in ((r.child, r.column), (r.parent, r.parent_column)):
            schema, table = name.split(".")
            collection = next(c for c in CL.COLLECTIONS.values() if c.name == schema)
            assert column in dict(collection.table(table).schema())

"""Profiles and row generators read keys, kinds and typed items, not copies of whole values."""
from pyspark.sql import functions as F

from docnorm.functions import values as V
from docnorm.operators import nested as N
from docnorm.operators import profile as G
from docnorm.plans import queries as Q

SMALL = "/root/testdata/sf0.001"
ODD = [None, False, True, 0, 0.0, -0.5, 7, "", "0", "false", "true", "True", "[]", "{}", [], {}, [0], {"a": 1}, "{x",
       "-0", "x", -3, 1.5, [None], "0.0"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_of_truthy_values(docs):
    rows = docs(*[{"v": v} for v in ODD], {}).select(
        "_seq", V.truthy_str_at("doc", "v").alias("got"),
        F.when(V.truthy(V.at("doc", "v")), V.str_at("doc", "v")).alias("want")).orderBy("_seq").collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert [r.got is not None for r in rows] == [bool(v) for v in ODD] + [False]


def test_sizes_and_kinds_of_odd_values(docs):
    rows = docs(*[{"v": v} for v in ODD], {}).select(
        "_seq", V.array_size("doc", "v").alias("n"), V.object_keys("doc", "v").alias("keys"),
        V.kind(V.at("doc", "v")).alias("kind")).orderBy("_seq").collect()
    names = {type(None): "null", bool: "boolean", int: "integer", float: "float", str: "string", list: "array", dict: "object"}
    assert [r.n for r in rows] == [len(v) if isinstance(v, list) else None for v in ODD] + [None]
    assert [r["keys"] for r in rows] == [list(v) if isinstance(v, dict) else None for v in ODD] + [None]
    assert [r.kind for r in rows][:-1] == [names[type(v)] if v != 0.0 or isinstance(v, (bool, int)) else "float" for v in ODD]
    assert rows[-1].kind == "missing"


def test_foreign_key_candidates_read_each_text_once(docs):  # F30
    d = docs(*[{"k": v} for v in ODD], {"k": 7}, {})
    got = G.fk_candidates(d, ["k", "none"])
    assert "_text0" in optimized(got)
    want = d.select(F.when(V.truthy(V.at("doc", "k")), V.str_at("doc", "k")).alias("t"))
    n, distinct = want.agg(F.count("t"), F.countDistinct("t")).first()
    assert sorted(tuple(r) for r in got.collect()) == [("k", n, distinct), ("none", 0, 0)]


def test_containers_are_counted_without_their_items(docs):  # F31
    d = docs({"c": {"a": [1, {"x": 2}], "b": []}}, {"c": {"a": "text", "b": [None]}}, {"c": [1]}, {"c": None}, {})
    df = G.container_profile(d, "c", ["a", "b"])
    assert df._jdf.queryExecution().analyzed().toString().count("variant_get(") == 2
    assert sorted(tuple(r) for r in df.collect()) == [("c", "a", 1, 2), ("c", "b", 1, 1)]


def test_dynamic_patterns_read_keys_only(docs):  # F32
    d = docs({"a_1": [1], "a_2": None, "b_1": {}, "_3": 0, "__v": 1, "_id": 2, "x": 3, "c_d": 4}, {"a_1": 1}, [1], {})
    df = G.dynamic_patterns(d)
    assert "map_keys" in optimized(df)
    assert [tuple(r)[:3] for r in df.orderBy("rank").collect()] == [("a", 2, 3), ("b", 1, 1)]


def test_entries_are_parts_of_the_document(docs):  # F33
    d = docs({"a": [{"x": 1}, {}], "b": [], "c": [1, "t", None, 1.5, True, [2], {}], "d": {"e": [1]}, "n": None}, [1, 2], 3, {"a": [None]})
    df = G.array_profile(d)
    assert "variant_explode" in optimized(df)
    assert sorted(tuple(r) for r in df.collect()) == [
        ("a", 2, 2, 1, 2, 1.5, "null,object"), ("b", 1, 0, 0, 0, 0.0, ""),
        ("c", 1, 1, 7, 7, 7.0, "array,boolean,float,integer,null,object,string")]
    assert sorted((r._seq, r.field, r.kind) for r in G.entries(d).collect()) == [
        (0, "a", "array"), (0, "b", "array"), (0, "c", "array"), (0, "d", "object"), (0, "n", "null"), (3, "a", "array")]
    assert [(r.field, r.kind) for r in G.entries(d, "d").collect()] == [("e", "array")]


def test_dynamic_fields_are_filtered_once(docs):  # F34
    d = docs({"a_1": "x", "b_2": "", "c_3": [], "d_4": {}, "e_5": 0, "_6": None, "_7": False, "_id": 1, "k": 2, "g9": 3, "h_": 4},
             {"k": 1}, [1], {"_v": 1, "é_1": 2})
    df = d.select("_seq", V.json_text(N.dynamic_fields_regex("doc")).alias("j"))
    assert optimized(df).count("map_filter(") == 1
    assert [r.j for r in df.orderBy("_seq").collect()] == ['{"_7":false,"a_1":"x","d_4":{},"e_5":0}', None, None, '{"é_1":2}']


def test_items_are_read_as_the_named_fields(docs):  # F36
    d = docs({"a": [{"line": 3, "id": "x"}, 5, None, {"line": "4"}, {"line": "z"}, {}]}, {"a": {"line": 1}}, {})
    df = N.explode_array(d, "a", keep=["_seq"], item_type="struct<line:bigint>")
    assert [(r._seq, r.pos, r.item and r.item.line) for r in df.collect()] == [
        (0, 0, 3), (0, 1, None), (0, 2, None), (0, 3, 4), (0, 4, None), (0, 5, None)]
    assert df.where("item IS NULL").count() == 2


def test_recipients_are_read_once_an_id(spark, docs, monkeypatch):  # F36
    users = [{"id": v, "name": "n"} for v in ODD] + [{"name": "no id"}, "text", None, 3]
    d = docs({"_id": "p", "recipients": {"users": users}}, {"_id": "q", "recipients": None}, {})
    monkeypatch.setattr(Q, "orders_docs", lambda spark, path: d)
    df = Q._recipient_users(spark, SMALL)
    truth = [(0, i, "p", r.t, "n") for i, r in enumerate(docs(*[{"v": v} for v in ODD]).orderBy("_seq").select(
        F.when(V.truthy(V.at("doc", "v")), V.str_at("doc", "v")).alias("t")).collect()) if r.t is not None]
    assert sorted(tuple(r) for r in df.collect()) == truth
    assert "_text#" in optimized(df) and "_fence#" in optimized(df)

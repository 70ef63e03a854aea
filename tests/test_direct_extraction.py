"""Values are taken from a document by path and type at once, and only the wanted tables are planned."""
from pyspark.sql import functions as F

from docnorm.functions import values as V
from docnorm.operators import nested as N
from docnorm.plans import collections as CL
from docnorm.plans.spec import normalise


def test_arrays_are_not_copied_before_they_are_exploded(docs):
    d = docs({"a": [1, {"b": 2}]}, {"a": {}}, {"a": None}, {})
    df = N.explode_array(d, "a", keep=["_seq"])
    assert df.count() == 2
    assert df._jdf.queryExecution().analyzed().toString().count("variant_get(") == 1


def test_columns_of_child_rows_are_read_in_their_type(docs):
    d = docs({"_id": {"$oid": "x"}, "signers": [{"id": 5, "name": "n"}, {"id": 0}, {"id": "0"}, {"id": True}]})
    t = normalise(CL.DOCUMENTS, d, only=["signers"]).tables
    assert set(t) == {"signers"}
    assert sorted(tuple(r) for r in t["signers"].select("document_id", "user_id", "user_name").collect()) == [
        ("x", "0", None), ("x", "5", "n"), ("x", "True", None)]


def test_text_and_truth_of_odd_values(docs):
    values = [None, False, True, 0, 0.0, -0.5, 7, "", "0", "false", "true", "[]", "{}", [], {}, [0], {"a": 1}, "{x"]
    rows = docs(*[{"v": v} for v in values], {}).select(
        "_seq", V.truthy(V.at("doc", "v")).alias("t"), V.str_at("doc", "v").alias("s")).orderBy("_seq").collect()
    assert [r.t for r in rows] == [bool(v) for v in values] + [False]
    assert [r.s for r in rows] == [None, "False", "True", "0", "0", "-0.5", "7", "", "0", "false", "true", "[]", "{}",
                                   "[]", "{}", "[0]", '{"a":1}', "{x", None]


def test_ids_of_all_kinds(docs):
    ids = [{"$oid": "h"}, "h", 3, {}, {"$oid": None}, None, [1]]
    d = docs(*[{"_id": i} for i in ids], {})
    assert [r[0] for r in d.orderBy("_seq").select(V.oid("doc")).collect()] == ["h", "h", "3", None, None, None, "[1]", None]

"""Row generators (X1–X12, D1, D2): FIXTURES §2 rows 7–9, 11, 12."""
import json

from pyspark.sql import functions as F

from docnorm.functions import values as V
from docnorm.operators import nested as N


def test_posexplode_keeps_gaps(docs):
    d = docs({"fields": [{"key": "a"}, 7, {"key": "b"}]})
    out = N.explode_array(d, "fields", keep=["_seq"]).where(N.object_items())
    assert [(r.pos, V.get(F.lit(None), "x") is not None) for r in out.collect()] and \
        [r.pos for r in out.orderBy("pos").collect()] == [0, 2]


def test_null_array_gives_no_rows(docs):
    d = docs({"fields": None}, {}, {"fields": "x"})
    assert N.explode_array(d, "fields").count() == 0


def test_map_explode_object_values_only(docs):
    d = docs({"initiatorFields": {"a": {"id": 1, "name": "n"}, "b": "x"}})
    out = N.explode_object(d, "initiatorFields").where(N.object_items())
    assert [r.key for r in out.collect()] == ["a"]


def test_tagged_union_skips_non_arrays(docs):
    d = docs({"recipients": {"users": {"id": 1}, "areas": [{"id": 2}, {"id": 3}]}})
    out = N.tagged_union(d, {"user": "recipients.users", "area": "recipients.areas"}).where(N.object_items())
    assert sorted((r.tag, r.pos) for r in out.collect()) == [("area", 0), ("area", 1)]


def test_unpivot_objects_drops_falsy(docs):
    d = docs({"a": {"id": 1}, "b": {}, "c": None})
    out = N.unpivot_objects(d, {"A": "a", "B": "b", "C": "c"})
    assert [r.tag for r in out.collect()] == ["A"]


def test_dynamic_regex(docs):
    d = docs({"campo_1": "", "_3": 0, "x_2": [], "y_9": {}, "__v": 1, "_id": "k", "z_4": None, "w_5": "v"})
    got = d.select(V.json_text(N.dynamic_fields_regex("doc"))).first()[0]
    assert json.loads(got) == {"_3": 0, "y_9": {}, "w_5": "v"}


def test_dynamic_regex_none(docs):
    d = docs({"campo": "x"})
    assert d.select(N.dynamic_fields_regex("doc")).first()[0] is None


def test_dynamic_fixed(docs):
    d = docs({"_3": 0, "_4": "v", "_8": "v", "_5": {}})
    got = d.select(V.json_text(N.dynamic_fields_fixed("doc", ["_3", "_4", "_5", "_6", "_7"]))).first()[0]
    assert json.loads(got) == {"_4": "v"}


def test_explode_is_narrow(docs):
    d = docs({"a": [1, 2]})
    plan = N.explode_array(d, "a")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

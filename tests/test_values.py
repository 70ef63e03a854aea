"""Value rules (P1–P6, S1–S12) on hand-made edge documents (FIXTURES §2 rows 1–6, 10, 21)."""
import datetime as dt

from pyspark.sql import functions as F

from docnorm.functions import values as V


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_default_if_missing_keeps_explicit_null(docs):
    d = docs({}, {"deleted": None}, {"deleted": True})
    assert one(d.orderBy("_seq"), V.default_if_missing("doc", "deleted", "boolean", False)) == [False, None, True]


def test_truthy_coalesce(docs):
    d = docs({"lumbre_version": 0, "lumbreVersion": 2}, {"lumbreVersion": 3}, {"lumbre_version": 5, "lumbreVersion": 2})
    assert one(d.orderBy("_seq"), V.ct("doc", ["lumbre_version", "lumbreVersion"], "int")) == [2, 3, 5]


def test_object_guard(docs):
    d = docs({"role": "text"}, {"role": {}}, {"role": {"id": ""}}, {"role": {"id": "r1"}})
    assert one(d.orderBy("_seq"), V.sub("doc", "role", "id")) == [None, None, "", "r1"]


def test_truthiness_table(docs):
    vals = [0, "", [], {}, False, 0.0, None, "x", [0], {"a": None}, True, 1.5]
    d = docs(*[{"v": v} for v in vals], {})
    got = one(d.orderBy("_seq"), V.truthy(V.at("doc", "v")))
    assert got == [False] * 7 + [True] * 5 + [False]


def test_timestamps_parsed(docs):
    d = docs({"t": "2021-03-22T07:49:18.242Z"}, {"t": "2021-03-22T07:49:18Z"},
             {"t": {"$date": "2021-03-22T07:49:18.242Z"}}, {"t": "2022-06-02T13:54:12.273+00:00"},
             {"t": "2022-06-02T13:54:12.273-03:00"})
    got = one(d.orderBy("_seq"), V.ts_at("doc", "t"))
    assert got == [dt.datetime(2021, 3, 22, 7, 49, 18, 242000), dt.datetime(2021, 3, 22, 7, 49, 18),
                   dt.datetime(2021, 3, 22, 7, 49, 18, 242000), dt.datetime(2022, 6, 2, 13, 54, 12, 273000),
                   dt.datetime(2022, 6, 2, 16, 54, 12, 273000)]


def test_timestamps_rejected(docs):
    d = docs({"t": "2022-06-02"}, {"t": "2022-06"}, {"t": 12345}, {"t": {"$date": 5}}, {"t": ""},
             {"t": "2021-02-30T07:49:18Z"}, {"t": None}, {})
    assert one(d, V.ts_at("doc", "t")) == [None] * 8


def test_timestamp_fallback_is_strict(docs):
    d = docs({"created_at": "2025-01-15T10:30:00.5Z"}, {"created_at": "2025-01-15T10:30:00Z"},
             {"createdAt": "bad", "created_at": "2025-01-15T10:30:00Z"})
    got = one(d.orderBy("_seq"), V.ts_with_fallback("doc", "createdAt", "created_at"))
    assert got == [None, dt.datetime(2025, 1, 15, 10, 30), dt.datetime(2025, 1, 15, 10, 30)]


def test_json_forms(docs):
    d = docs({"v": {}}, {"v": []}, {"v": {"a": 1}}, {"v": 0}, {})
    jt = one(d.orderBy("_seq"), V.json_text(V.json_truthy(V.at("doc", "v"))))
    jv = one(d.orderBy("_seq"), V.json_text(V.json_container(V.at("doc", "v"))))
    assert jt == [None, None, '{"a":1}', None, None]
    assert jv == ["{}", "[]", '{"a":1}', None, None]


def test_full_name_missing_and_null_parts(docs):
    d = docs({"u": {"firstname": "Ana"}}, {"u": {"firstname": "Ana", "lastname": None}},
             {"u": {"firstname": "Ana", "lastname": "Diaz"}}, {"u": {}})
    assert one(d.orderBy("_seq"), V.full_name("doc", base="u")) == ["Ana", "Ana", "Ana Diaz", ""]


def test_oid_and_str(docs):
    d = docs({"_id": {"$oid": "abc"}}, {"_id": "plain"}, {"_id": 42}, {"_id": True})
    assert one(d.orderBy("_seq"), V.oid("doc")) == ["abc", "plain", "42", "True"]


def test_snake_and_singular():
    assert V.snake("processTypeId") == "process_type_id"
    assert V.snake("messageAfterPOSTorPUT") == "message_after_pos_tor_put"
    assert [V.singular(x) for x in ("users", "areas", "subareas", "groups")] == ["user", "area", "subarea", "group"]


def test_has_data(docs):
    d = docs({"v": None}, {"v": "  "}, {"v": []}, {"v": {"a": None, "b": ""}}, {"v": {"a": {"b": []}}},
             {"v": 0}, {"v": False}, {"v": {"a": {"b": [None]}}}, {"v": {"a": "x"}})
    assert one(d.orderBy("_seq"), V.has_data(V.at("doc", "v"))) == [False, False, False, False, False,
                                                                      True, True, True, True]


def test_kind_lattice(docs):
    d = docs({"v": None}, {"v": {}}, {"v": []}, {"v": True}, {"v": 1}, {"v": 1.0}, {"v": "s"}, {})
    assert one(d.orderBy("_seq"), V.kind(V.at("doc", "v"))) == [
        "null", "object", "array", "boolean", "integer", "float", "string", "missing"]

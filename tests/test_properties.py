"""Property tests: the value rules agree with the source language's own semantics
(truthiness, kinds, text of scalars, recursive emptiness) on random JSON values."""
import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from docnorm.functions import values as V

TEXT = st.text(alphabet=st.sampled_from(list("ab xyZ\t\n.-:")), max_size=6)
SCALARS = st.none() | st.booleans() | st.integers(-2 ** 40, 2 ** 40) | TEXT | \
    st.floats(allow_nan=False, allow_infinity=False, width=32).map(lambda f: round(f, 3))
JSON = st.recursive(SCALARS, lambda inner: st.lists(inner, max_size=3) |
                    st.dictionaries(st.sampled_from(["a", "b", "c"]), inner, max_size=3), max_leaves=8)


def py_kind(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "integer"
    if isinstance(v, float):
        return "float"
    if isinstance(v, str):
        return "string"
    return "array" if isinstance(v, list) else "object"


def py_has_data(v):
    if v is None:
        return False
    if isinstance(v, dict):
        return any(py_has_data(x) for x in v.values())
    if isinstance(v, list):
        return len(v) > 0
    if isinstance(v, str):
        return v.strip() != ""
    return True


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(JSON, min_size=1, max_size=60))
def test_rules_match_python_semantics(spark, values):
    rows = [(i, json.dumps({"v": v})) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i long, j string").select("i", F.parse_json("j").alias("doc"))
    v = V.at("doc", "v")
    got = {r["i"]: r for r in df.select("i", V.truthy(v).alias("t"), V.kind(v).alias("k"),
                                        V.has_data(v).alias("h")).collect()}
    for i, val in enumerate(values):
        r = got[i]
        assert r["t"] == bool(val), (val, r)
        # JSON numbers written with a fraction are floats even when integral (1.0)
        assert r["k"] == py_kind(val), (val, r)
        assert r["h"] == py_has_data(val), (val, r)

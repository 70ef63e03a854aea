"""Column expressions over VARIANT document values.

Every function takes and returns ``Column`` objects, so it stays inside Catalyst
(whole-stage codegen where Spark supports it) and never goes through Python per row.

Vocabulary (what a nested document field can be):
  missing   the key is absent                       -> SQL NULL from ``at``
  null      the key is present with JSON null       -> ``is_variant_null``
  truthy    not missing/null/false/0/''/[]/{}       -> ``truthy``
"""
from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column, functions as F

ARRAY_T = "array<variant>"
OBJECT_T = "map<string,variant>"
# Casts that tell what a container holds without its values: an item is an empty struct when it
# is an object, else NULL. A VARIANT item or value is written anew, keys and all, by its cast.
ITEMS_T = "array<struct<>>"
FIELDS_T = "map<string,struct<>>"

_SIMPLE_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


# --------------------------------------------------------------------------- paths
def jpath(path: str | Iterable[str] | None) -> str:
    """Dotted name (``createdBy.user.id``) or list of keys -> JSON path (``$.createdBy.user.id``).

    Keys that are not plain identifiers (``$oid``, ``$date``) are quoted: ``$['$oid']``.
    """
    if path is None or path == "" or path == "$":
        return "$"
    if isinstance(path, str):
        if path.startswith("$"):
            return path
        parts = path.split(".")
    else:
        parts = list(path)
    out = "$"
    for p in parts:
        if _SIMPLE_KEY.match(p):
            out += "." + p
        else:
            out += "['" + p.replace("'", "\\'") + "']"
    return out


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(v: Column | str, path: str | None = None) -> Column:
    """VARIANT at ``path``; SQL NULL when the key is missing (JSON null stays a variant null)."""
    v = col_of(v)
    p = jpath(path)
    if p == "$":
        return v
    return F.try_variant_get(v, p, "variant")


def get(v: Column | str, path: str | None, dtype: str = "string") -> Column:
    """Typed value at ``path`` (``g(p)``): NULL when missing, null or not castable."""
    return F.try_variant_get(col_of(v), jpath(path), dtype)


# --------------------------------------------------------------------------- kinds
def schema(v: Column) -> Column:
    return F.schema_of_variant(v)


def as_array(v: Column) -> Column:
    """``array<variant>`` when ``v`` is a JSON array, else NULL."""
    return F.try_variant_get(v, "$", ARRAY_T)


def array_at(v: Column | str, path: str | None) -> Column:
    """``as_array`` of the value at ``path``, without a copy of that value as a VARIANT."""
    return get(v, path, ARRAY_T)


def object_at(v: Column | str, path: str | None) -> Column:
    """``as_object`` of the value at ``path``, without a copy of that value as a VARIANT."""
    return get(v, path, OBJECT_T)


def as_object(v: Column) -> Column:
    """``map<string,variant>`` when ``v`` is a JSON object, else NULL."""
    return F.try_variant_get(v, "$", OBJECT_T)


def is_missing(v: Column) -> Column:
    return v.isNull()


def is_null(v: Column) -> Column:
    """Present with JSON null."""
    return F.coalesce(F.is_variant_null(v), F.lit(False))


def is_array(v: Column) -> Column:
    return get(v, "$", ITEMS_T).isNotNull()


def array_size(v: Column | str, path: str | None = None) -> Column:
    """Number of items of the array at ``path``; NULL when it is no array."""
    return F.size(get(v, path, ITEMS_T))


def object_keys(v: Column | str, path: str | None = None) -> Column:
    """Keys of the object at ``path``; NULL when it is no object."""
    return F.map_keys(get(v, path, FIELDS_T))


def is_object(v: Column) -> Column:
    # an empty-struct cast succeeds exactly for objects and reads no field: O(1), where a
    # map cast would copy every key and schema_of_variant would walk the whole value
    return is_object_at(v, "$")


def is_object_at(v: Column | str, path: str | None) -> Column:
    return get(v, path, "struct<>").isNotNull()


def _scalar_schema(v: Column) -> Column:
    # schema_of_variant walks the whole value; only call it on scalars (guarded by CASE).
    return schema(v)


def is_string(v: Column) -> Column:
    return F.coalesce(
        F.when(v.isNull() | is_array(v) | is_object(v), F.lit(False)).otherwise(_scalar_schema(v) == "STRING"),
        F.lit(False),
    )


def kind(v: Column) -> Column:
    """Profiler type lattice: missing / null / object / array / boolean / integer / float / string.

    Integers are BIGINT-family variants; any DECIMAL or DOUBLE is ``float`` (JSON ``1.0``
    is a float in the source language even though Spark stores it as DECIMAL(1,0)).
    """
    s = _scalar_schema(v)
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(F.is_variant_null(v), F.lit("null"))
        .when(is_object(v), F.lit("object"))
        .when(is_array(v), F.lit("array"))
        .when(s == "STRING", F.lit("string"))
        .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("integer"))
        .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), F.lit("float"))
        .when(s == "BOOLEAN", F.lit("boolean"))
        .when(s.startswith("TIMESTAMP"), F.lit("datetime"))
        .otherwise(F.lower(s))
    )


def truthy(v: Column) -> Column:
    """False for missing, null, false, 0, 0.0, '', [] and {}; true otherwise."""
    s = _scalar_schema(v)
    items = array_size(v)
    text = F.try_variant_get(v, "$", "string")
    return F.coalesce(
        F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
        .when(items.isNotNull(), items > 0)
        .when(is_object(v), F.size(object_keys(v)) > 0)
        # no text of a zero or of false: the schema, which is dear to tell, need not be known
        .when((text != "") & ~text.rlike("^(-?[0.]|false$)"), F.lit(True))
        .when(s == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(
            s.startswith("DECIMAL") | s.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT"),
            F.try_variant_get(v, "$", "double") != 0,
        )
        .when(s == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .otherwise(F.lit(True)),
        F.lit(False),
    )


def truthy_str(c: Column) -> Column:
    """Truthiness of an already typed string column."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


# --------------------------------------------------------------------------- P2–P6
def sub(v: Column | str, obj_path: str, key: str, dtype: str = "string") -> Column:
    """``sub(o,k)``: ``o.k`` only when ``o`` is an object (a path into a non-object is NULL)."""
    base = jpath(obj_path)
    return F.try_variant_get(col_of(v), base + jpath([key])[1:], dtype)


def default_if_missing(v: Column | str, path: str, dtype: str, default) -> Column:
    """``d(p,x)``: ``x`` only when the key is missing; an explicit null stays NULL."""
    raw = at(v, path)
    return F.when(raw.isNull(), F.lit(default).cast(dtype)).otherwise(F.try_variant_get(raw, "$", dtype))


def coalesce_truthy(*vals: Column) -> Column:
    """``ct(a,b,...)``: first truthy VARIANT; the last one is returned as is (may be falsy/NULL)."""
    out = vals[-1]
    for v in reversed(vals[:-1]):
        out = F.when(truthy(v), v).otherwise(out)
    return out


def _scalar_id(v: Column) -> Column:
    """Text of a truthy scalar, else NULL; smaller code than ``truthy``, whose container
    tests a scalar does not need."""
    text = to_str(v)
    zero = F.coalesce(F.try_variant_get(v, "$", "double"), F.lit(1.0)) == 0
    return F.when((F.length(text) > 0) & ((schema(v) == "STRING") | ~zero), text)


def user_id(v: Column | str, first: str = "id", second: str = "_id") -> Column:
    """Id text of an object's ``id``, else ``_id``; an id object gives its ``$oid``. NULL when
    both are falsy or the object holds none."""
    a, b = at(v, first), at(v, second)
    def oid_text(x):
        return F.nullif(F.try_variant_get(x, jpath(["$oid"]), "string"), F.lit(""))
    return (F.when(is_object(a) & (F.size(as_object(a)) > 0), oid_text(a))
            .otherwise(F.coalesce(_scalar_id(a), F.when(is_object(b), oid_text(b)).otherwise(_scalar_id(b)))))


def ct(v: Column | str, paths: list[str], dtype: str = "string") -> Column:
    """Truthy coalesce of several paths, typed."""
    return F.try_variant_get(coalesce_truthy(*[at(v, p) for p in paths]), "$", dtype)


def flag(v: Column | str, path: str, default: bool) -> Column:
    """P5: boolean option with a default when missing (or when the parent is not an object)."""
    return default_if_missing(v, path, "boolean", default)


# --------------------------------------------------------------------------- S1, S10
def to_str(v: Column) -> Column:
    """Python-``str()`` of a scalar VARIANT (``True``/``False`` for booleans); NULL for null."""
    return str_at(v, "$")


def str_at(v: Column | str, path: str | None) -> Column:
    """``to_str`` of the value at ``path``. Its text tells most kinds apart, so the value itself
    and its schema are looked at only where the text leaves a doubt."""
    txt = get(v, path, "string")
    raw = at(v, path)
    return (
        F.when((txt.startswith("{") | txt.startswith("[")) & (is_array(raw) | is_object(raw)), F.to_json(raw))
        .when(txt.isin("true", "false") & (_scalar_schema(raw) == "BOOLEAN"), F.initcap(txt))
        .otherwise(txt)
    )


# Texts that alone do not tell whether a value is truthy, or how ``str_at`` writes it.
_DOUBTFUL = r"^(-?[0.]|true$|false$|[\[{])"


def plain_text(text: Column) -> Column:
    """Whether a value read as ``text`` is surely a truthy scalar, which ``str_at`` writes so."""
    return F.coalesce((text != "") & ~text.rlike(_DOUBTFUL), F.lit(False))


def truthy_at(v: Column | str, path: str | None) -> Column:
    """``truthy`` of the value at ``path``, which is mostly a scalar: its text tells, and the value
    itself is looked at only where the text leaves a doubt."""
    return F.when(plain_text(get(v, path, "string")), F.lit(True)).otherwise(truthy(at(v, path)))


def truthy_str_at(v: Column | str, path: str | None, text: Column | None = None) -> Column:
    """``str_at`` when the value at ``path`` is ``truthy``, else NULL. ``text`` may give the value
    read as text by an earlier projection; beyond it, only a doubtful one is looked at."""
    text = get(v, path, "string") if text is None else text
    return F.when((text != "") & ~text.rlike(_DOUBTFUL), text).when(
        (text != "") & truthy(at(v, path)), str_at(v, path))


def oid(v: Column | str, path: str = "_id") -> Column:
    """Document key: unwrap ``{"$oid": h}`` else ``str(value)``."""
    return F.coalesce(get(v, jpath(path) + "['$oid']", "string"), F.when(~is_object_at(v, path), str_at(v, path)))


# --------------------------------------------------------------------------- S2–S5
# Fixed formats of the source timestamps:
#   text ending in Z:   %Y-%m-%dT%H:%M:%S[.%f]Z  (1–6 fraction digits; '.' requires a fraction)
#   text with offset:   ISO date 'T'/' ' time [.fraction] with +HH:MM / -HH:MM / +HHMM / +HH
#   anything else (date-only text, non-text $date): NULL
_TS_Z = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z$"
_TS_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?([+-]\d{2}(:?\d{2})?)?$"
_TS_PLAIN_Z = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$"
_FMT_Z = "y-M-d'T'H:m:s[.SSSSSS]XXX"
_FMT_ISO = "yyyy-MM-dd'T'HH[:mm[:ss[.SSSSSS]]][XXX][XX][X]"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def instant_to_utc(inst: Column) -> Column:
    """Absolute instant -> zone-less UTC wall clock, independent of the session time zone."""
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_micros(inst) / F.lit(1000000))


def ts_text(t: Column) -> Column:
    """Flexible timestamp from text, result TIMESTAMP_NTZ in UTC (NULL when not parseable)."""
    z = F.endswith(t, F.lit("Z"))
    offset_like = F.contains(t, F.lit("+")) | ((F.length(t) - F.length(F.regexp_replace(t, "-", ""))) > 2)
    zfix = F.concat(t.substr(F.lit(1), F.length(t) - 1), F.lit("+00:00"))
    isofix = F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 10_000))
    inst = F.when(z & t.rlike(_TS_Z), F.try_to_timestamp(zfix, F.lit(_FMT_Z))).when(
        ~z & offset_like & t.rlike(_TS_ISO), F.try_to_timestamp(isofix, F.lit(_FMT_ISO))
    )
    return instant_to_utc(inst)


def ts(v: Column) -> Column:
    """``ts(v)`` (S2): native timestamp kept, ``{"$date": text}`` unwrapped, text parsed, rest NULL.

    No type test is needed before parsing: a non-text value read as text (a number, JSON of
    an object or array, ``true``) never matches the timestamp patterns."""
    return ts_at(v, "$")


def ts_at(v: Column | str, path: str) -> Column:
    text = F.coalesce(get(v, jpath(path) + "['$date']", "string"), get(v, path, "string"))
    native = F.when(schema(at(v, path)).startswith("TIMESTAMP"), get(v, path, "timestamp_ntz"))
    return F.coalesce(ts_text(text), native)


def ts_strict_z(v: Column) -> Column:
    """Legacy text timestamp ``%Y-%m-%dT%H:%M:%SZ`` only (no fraction, no offset)."""
    text = F.when(schema(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return F.when(text.rlike(_TS_PLAIN_Z), ts_text(text))


def ts_with_fallback(v: Column | str, primary: str, fallback: str) -> Column:
    """S3: ts(primary); if that gives nothing, the fallback field as strict Z text when truthy."""
    fb = at(v, fallback)
    return F.coalesce(ts_at(v, primary), F.when(truthy(fb), ts_strict_z(fb)))


def ts_or(v: Column | str, path: str, default: Column) -> Column:
    """ts(path) or a default (``run_ts`` for created, created for updated)."""
    return F.coalesce(ts_at(v, path), default)


def raw_timestamp(v: Column | str, path: str) -> Column:
    """Raw text into a zone-less TIMESTAMP column; a zone suffix is ignored, failures are NULL."""
    return F.try_variant_get(col_of(v), jpath(path), "string").try_cast("timestamp_ntz")


# --------------------------------------------------------------------------- S6–S9
def part_str(v: Column | str, path: str | None = None) -> Column:
    """Name part: missing or null -> ''."""
    return F.coalesce(str_at(v, path), F.lit(""))


def full_name(v: Column | str, first: str = "firstname", last: str = "lastname", base: str | None = None) -> Column:
    """``trim(first + ' ' + last)`` with missing/null parts as ''."""
    before = f"{base}." if base else ""
    return F.trim(F.concat(part_str(v, before + first), F.lit(" "), part_str(v, before + last)))


def json_truthy(v: Column) -> Column:
    """``jt``: the value when truthy else NULL ({} [] 0 '' -> NULL). Stays VARIANT."""
    return F.when(truthy(v), v)


def json_container(v: Column) -> Column:
    """``jv``: the value when it is an object or array (empty ones kept) else NULL."""
    return json_container_at(v, "$")


def json_container_at(v: Column | str, path: str | None) -> Column:
    return F.when(is_object_at(v, path) | array_at(v, path).isNotNull(), at(v, path))


def singular(tag: str) -> str:
    """The source strips every trailing 's' of the container name."""
    return tag.rstrip("s")


# --------------------------------------------------------------------------- S12
def snake(name: str) -> str:
    """camelCase -> snake_case for default column names (``processTypeId`` -> ``process_type_id``)."""
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    return s.lower()


def json_text(v: Column) -> Column:
    """Canonical JSON text of a VARIANT (keys sorted by the variant encoding)."""
    return F.to_json(v)


# --------------------------------------------------------------------------- G21
_JSON_KEY = r'"(?:[^"\\]|\\.)*":'
_JSON_BLANK_STR = r'"(?:\s|\\[tnrf]|\\u000[bB]|\\u001[c-fC-F])*"'
_JSON_STR = r'"(?:[^"\\]|\\.)*"'


def has_data(v: Column) -> Column:
    """Recursive emptiness test: NULL, blank text, empty arrays and objects whose values
    all lack data -> false; numbers and booleans (0, false included) and non-empty arrays
    -> true. Works on the JSON text, so nesting depth is unbounded."""
    j = F.to_json(v)
    no_keys = F.regexp_replace(j, _JSON_KEY, "")
    # every string becomes one letter first (B blank, S text) so brackets inside text vanish;
    # blank text is whitespace as raw characters or as the JSON escapes to_json writes for it
    blanks = F.regexp_replace(no_keys, "(?U)" + _JSON_BLANK_STR, "B")
    strs = F.regexp_replace(blanks, _JSON_STR, "S")
    nonempty_array = strs.rlike(r"\[[^\]]")
    rest = F.regexp_replace(strs, r"null|B|\[\]|[{},]", "")
    return F.coalesce(F.when(v.isNull(), F.lit(False)).otherwise(nonempty_array | (F.length(rest) > 0)), F.lit(False))


def ts_string(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff`` text of a TIMESTAMP_NTZ, independent of the session
    time zone (``date_format`` on zone-less values still applies the session zone's
    daylight-saving gaps; the string cast does not)."""
    s = ts.cast("timestamp_ntz").cast("string")
    return F.when(F.contains(s, F.lit(".")), F.rpad(s, 26, "0")).otherwise(F.concat(s, F.lit(".000000")))

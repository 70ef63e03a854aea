"""Row generators over nested VARIANT documents.

All generators are narrow (per-row ``explode``/``posexplode`` inside one projection):
they never shuffle, so a collection of any size splits across tasks like its input.
"""
from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import values as V

ITEM = "item"
POS = "pos"
KEY = "key"
TAG = "tag"


def _keep(df: DataFrame, keep: Sequence[str | Column] | None) -> list:
    if keep is None:
        return [c for c in df.columns]
    return list(keep)


def _generated(df: DataFrame, cols: list, given: Column, generator, *names: str) -> DataFrame:
    """Rows of ``generator`` over ``given``, beside ``cols``.

    Columns and the generator's input are computed first, once per document, so the
    generator carries neither the document nor expressions over it from item to item.
    """
    narrow = df.select(*cols, given.alias("_given"))
    kept = [c for c in narrow.columns if c != "_given"]
    return narrow.select(*kept, generator(F.col("_given")).alias(*names))


def explode_array(
    df: DataFrame,
    path: str,
    keep: Sequence[str | Column] | None = None,
    doc: str = "doc",
    with_pos: bool = True,
    item: str = ITEM,
    pos: str = POS,
    item_type: str = "variant",
) -> DataFrame:
    """One row per element of the array at ``path`` (non-arrays give no rows).

    ``pos`` is the 0-based index counted **before** any later item filter, so gaps remain
    exactly as in the source when items are dropped afterwards. With a struct as ``item_type``
    items come as the named fields, each NULL when missing or not castable; an item that is
    no object is NULL.
    """
    arr = V.get(doc, path, f"array<{item_type}>")
    cols = _keep(df, keep)
    if with_pos:
        return _generated(df, cols, arr, F.posexplode, pos, item)
    return _generated(df, cols, arr, F.explode, item)


def explode_object(
    df: DataFrame,
    path: str,
    keep: Sequence[str | Column] | None = None,
    doc: str = "doc",
    key: str = KEY,
    item: str = ITEM,
    item_type: str = "variant",
) -> DataFrame:
    """One row per (key, value) of the object at ``path`` used as a map (``item_type`` as in
    ``explode_array``)."""
    m = V.get(doc, path, f"map<string,{item_type}>")
    return _generated(df, _keep(df, keep), m, F.explode, key, item)


def tagged_union(
    df: DataFrame,
    branches: dict[str, str],
    keep: Sequence[str | Column] | None = None,
    doc: str = "doc",
    tag: str = TAG,
    item: str = ITEM,
    pos: str = POS,
) -> DataFrame:
    """Union of several sibling arrays into one child table with a tag column.

    One scan: every branch becomes ``array<struct<tag, item>>``, the branches are
    concatenated in the given order and exploded once. ``pos`` is the position in that
    concatenation (branch order, then item order), i.e. the order the source visits them.
    """
    def tagger(t):
        return lambda x: F.struct(F.lit(t).alias(tag), x.alias(item))

    parts = []
    for t, p in branches.items():
        arr = F.coalesce(V.array_at(doc, p), F.array().cast("array<variant>"))
        parts.append(F.transform(arr, tagger(t)))
    allv = F.concat(*parts) if len(parts) > 1 else parts[0]
    out = _generated(df, _keep(df, keep), allv, F.posexplode, pos, "_u")
    return out.select(*[c for c in out.columns if c != "_u"], F.col("_u")[tag].alias(tag), F.col("_u")[item].alias(item))


def unpivot_objects(
    df: DataFrame,
    branches: dict[str, str],
    keep: Sequence[str | Column] | None = None,
    doc: str = "doc",
    tag: str = TAG,
    item: str = ITEM,
    truthy_only: bool = True,
) -> DataFrame:
    """Sibling **objects** to rows (one row per branch that holds a non-empty object), tagged."""
    arr = F.array(*[F.struct(F.lit(t).alias(tag), V.at(doc, p).alias(item)) for t, p in branches.items()])
    out = df.select(*_keep(df, keep), F.inline(arr))
    if truthy_only:
        out = out.where(F.size(V.as_object(F.col(item))) > 0)
    return out


def one_to_one(df: DataFrame, path: str, keep: Sequence[str | Column] | None = None, doc: str = "doc",
               item: str = ITEM) -> DataFrame:
    """An optional sub-object becomes its own row when truthy (at most one per document)."""
    sub = V.at(doc, path)
    return df.select(*_keep(df, keep), sub.alias(item)).where(V.truthy(F.col(item)))


def object_items(item: str = ITEM) -> Column:
    """P6 filter: array element is an object."""
    return V.is_object(F.col(item))


def string_items(item: str = ITEM) -> Column:
    """P6 filter: array element is a string."""
    return V.is_string(F.col(item))


def truthy_field(field: str, item: str = ITEM) -> Column:
    """P6 filter: element is an object whose ``field`` is truthy."""
    return V.is_object(F.col(item)) & V.truthy(V.at(item, field))


# --------------------------------------------------------------------------- D1, D2
def _object_from_map(m: Column) -> Column:
    # the one item of an array, since a CASE would compute the map for its condition and once more
    return F.transform(F.array(m), lambda x: F.when(F.size(x) > 0, F.to_variant_object(x)))[0]


def dynamic_fields_fixed(doc: Column | str, keys: Iterable[str]) -> Column:
    """Object of the listed top-level keys whose values are truthy; NULL when none."""
    d = V.col_of(doc)
    pairs = [F.struct(F.lit(k).alias("k"), V.at(d, [k]).alias("v")) for k in keys]
    kept = F.filter(F.array(*pairs), lambda x: V.truthy(x["v"]))
    return _object_from_map(F.map_from_entries(kept))


# Dynamic top-level key pattern and keys excluded from it.
DYNAMIC_KEY_PATTERN = r"^(.+_\d+|_\d+)$"
DYNAMIC_KEY_HOLDS = "_"  # text that every key of the pattern holds; most others are told by it
DYNAMIC_EXCLUDED = ("_id", "__v", "_v", "_master", "_masterType")


def _kept_dynamic_value(v: Column) -> Column:
    # drop JSON null, '' and []; keep 0, false and {}
    s = F.when(~V.is_array(v) & ~V.is_object(v), V.schema(v))
    return ~(
        F.is_variant_null(v)
        | F.coalesce((s == "STRING") & (F.try_variant_get(v, "$", "string") == ""), F.lit(False))
    ) & ~F.coalesce(V.array_size(v) == 0, F.lit(False))


def dynamic_fields_regex(doc: Column | str, pattern: str = DYNAMIC_KEY_PATTERN,
                         excluded: Sequence[str] = DYNAMIC_EXCLUDED) -> Column:
    """Object of top-level keys matching ``pattern`` (minus ``excluded``), values not
    null / '' / []; NULL when none. Per-row ``map_filter``, no shuffle."""
    m = V.as_object(V.col_of(doc))
    holds = DYNAMIC_KEY_HOLDS if pattern == DYNAMIC_KEY_PATTERN else ""
    kept = F.map_filter(m, lambda k, v: k.contains(holds) & ~k.isin(*excluded) & k.rlike(pattern) & _kept_dynamic_value(v))
    return _object_from_map(kept)


def top_level_entries(df: DataFrame, keep: Sequence[str | Column] | None = None, doc: str = "doc") -> DataFrame:
    """All (key, value) pairs of the document root; the base of most profiles."""
    return df.select(*_keep(df, keep), F.explode(V.as_object(F.col(doc))).alias(KEY, ITEM))

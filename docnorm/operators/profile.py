"""Profiling aggregates over a document collection.

Every profile is a distributed aggregation over ``(_seq, doc)``: top-level entries are
exploded once per document (narrow), then grouped by field. Grouping keys are field
names or bounded value sets, never documents; top-k lists use ``row_number() <= k``,
which Spark plans as a per-partition group limit before the shuffle. The only scalar
taken to the driver is the collection size (one ``count``) where a percentage needs it.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import values as V

SEQ = "_seq"
DOC = "doc"
KEY = "field"


def entries(docs: DataFrame, path: str | None = None, doc: str = DOC, seq: str = SEQ) -> DataFrame:
    """(``_seq``, field, value, kind) for every top-level key of the object at ``path``."""
    base = docs.select(seq, V.at(doc, path).alias("_given"))
    # values come as parts of their document; a cast to a map would write each of them anew
    ex = base.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("_given").outer()))
    ex = ex.where(F.col("key").isNotNull())  # items of an array have no key
    return ex.select(seq, F.col("key").alias(KEY), "value", V.kind(F.col("value")).alias("kind"))


def keys(docs: DataFrame, doc: str = DOC) -> DataFrame:
    """(field) for every top-level key of a document, without its value."""
    return docs.select(F.explode(V.object_keys(doc)).alias(KEY))


def total_docs(docs: DataFrame) -> int:
    """Collection size: one distributed count, the only scalar brought to the driver."""
    return docs.count()


def _types(kind: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(kind)), ",")


# --------------------------------------------------------------------------- G1–G4
def field_coverage(docs: DataFrame, total: int | None = None) -> DataFrame:
    """G1: per top-level field: documents having it, exact share in per cent, JSON nulls,
    type set, and whether the name is that of a dynamic field (``<base>_<n>``)."""
    total = total_docs(docs) if total is None else total
    e = entries(docs)
    agg = e.groupBy(KEY).agg(F.count(F.lit(1)).alias("present"), F.count_if(F.col("kind") == "null").alias("nulls"),
                             _types(F.col("kind")).alias("types"))
    return agg.select(KEY, "present", F.lit(total).cast("bigint").alias("total"),
                      (F.col("present") * 100 / F.lit(total)).alias("pct"), "nulls", "types", _is_dynamic(F.col(KEY)).alias("dynamic"))


def presence_pct(docs: DataFrame, total: int | None = None) -> DataFrame:
    """Integer-percent presence listing (floor), most present first."""
    cov = field_coverage(docs, total)
    return cov.select(KEY, "present", F.floor("pct").cast("bigint").alias("pct"))


def null_counts(docs: DataFrame, empty_is_null: bool = False) -> DataFrame:
    """Per field, values that are JSON null (and '' with ``empty_is_null``)."""
    e = entries(docs)
    cond = F.col("kind") == "null"
    if empty_is_null:
        cond = cond | ((F.col("kind") == "string") & (F.try_variant_get("value", "$", "string") == ""))
    return e.groupBy(KEY).agg(F.count_if(cond).alias("nulls"))


def example_text(v: Column, width: int = 60) -> Column:
    """Readable example: text cut to ``width``, arrays as ``array[n]``, objects as their keys."""
    arr = V.as_array(v)
    obj = V.as_object(v)
    return (F.when(arr.isNotNull(), F.concat(F.lit("array["), F.size(arr).cast("string"), F.lit("]")))
            .when(obj.isNotNull(), F.concat(F.lit("{"), F.array_join(F.array_sort(F.map_keys(obj)), ","), F.lit("}")))
            .when(F.is_variant_null(v), F.lit("null"))
            .otherwise(F.substring(V.to_str(v), 1, width)))


def field_examples(docs: DataFrame, k: int = 3, width: int = 60, truthy_only: bool = False) -> DataFrame:
    """Up to ``k`` distinct example values per field, in first-seen document order; with
    ``truthy_only``, falsy values ('' 0 false [] {}) give no example."""
    e = entries(docs).where(V.truthy(F.col("value")) if truthy_only else F.col("kind") != "null")
    ex = e.select(SEQ, KEY, example_text(F.col("value"), width).alias("example"))
    firsts = ex.groupBy(KEY, "example").agg(F.min(SEQ).alias("first_seq"))
    w = Window.partitionBy(KEY).orderBy("first_seq", "example")
    return (firsts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(KEY, F.col("rank").cast("bigint").alias("rank"), "example"))


# --------------------------------------------------------------------------- G5–G8
def array_profile(docs: DataFrame) -> DataFrame:
    """Per array field: documents with the array, with data, min/max/avg length, item types."""
    items = V.get("value", None, V.ITEMS_T)
    e = entries(docs).where(V.is_array(F.col("value"))).select(KEY, "value", items.alias("items"))
    # items are looked at one by one only where not all are objects
    kinds = (F.when(F.size("items") == 0, F.array().cast("array<string>"))
             .when(F.forall("items", lambda i: i.isNotNull()), F.array(F.lit("object")))
             .otherwise(F.array_distinct(F.transform(V.as_array(F.col("value")), lambda i: V.kind(i)))))
    x = e.select(KEY, F.size("items").alias("n"), kinds.alias("item_kinds"))
    return x.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("docs_with_array"), F.count_if(F.col("n") > 0).alias("docs_with_data"),
        F.min("n").cast("bigint").alias("min_len"), F.max("n").cast("bigint").alias("max_len"),
        F.avg("n").alias("avg_len"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_kinds")))), ",").alias("item_types"))


def array_items(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(``_seq``, field, pos, item) for every element of every top-level array field."""
    e = entries(docs, path).where(F.col("kind") == "array")
    return e.select(SEQ, KEY, F.posexplode(V.as_array(F.col("value"))).alias("pos", "item"))


def array_item_keys(docs: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent keys inside the object items of each array field (top ``top``)."""
    it = array_items(docs)
    keys = it.select(KEY, F.explode(F.map_keys(V.as_object(F.col("item")))).alias("item_key"))
    c = keys.groupBy(KEY, "item_key").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(KEY).orderBy(F.col("n").desc(), F.col("item_key"))
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(
        KEY, "item_key", "n", F.col("rank").cast("bigint").alias("rank"))


def array_distinct_ids(docs: DataFrame, id_field: str = "id") -> DataFrame:
    """Distinct ``id`` values inside the object items of each array field."""
    it = array_items(docs).select(KEY, V.to_str(V.at("item", id_field)).alias("item_id"))
    return it.where(F.col("item_id").isNotNull()).groupBy(KEY).agg(F.countDistinct("item_id").alias("distinct_ids"))


def object_profile(docs: DataFrame, top: int = 10, with_example: bool = False, width: int = 100) -> DataFrame:
    """Per object field: documents with it, its most frequent keys (top ``top``) and,
    with ``with_example``, the JSON of the first such object (cut to ``width``)."""
    e = entries(docs).where(F.col("kind") == "object")
    aggs = [F.count(F.lit(1)).alias("docs_with_object")]
    if with_example:
        aggs.append(F.min_by(F.substring(F.to_json(F.col("value")), 1, width), F.col(SEQ)).alias("example"))
    present = e.groupBy(KEY).agg(*aggs)
    keys = e.select(KEY, F.explode(F.map_keys(V.as_object(F.col("value")))).alias("sub_key"))
    c = keys.groupBy(KEY, "sub_key").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(KEY).orderBy(F.col("n").desc(), F.col("sub_key"))
    topk = c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    cols = [KEY, "docs_with_object", "sub_key", "n", F.col("rank").cast("bigint").alias("rank")]
    return topk.join(present, KEY).select(*cols, *(["example"] if with_example else []))


# --------------------------------------------------------------------------- G9–G12
def catalog_frequency(docs: DataFrame, path: str, id_field: str = "id", name_field: str = "name",
                      name_wins: str = "first", array: bool = False) -> DataFrame:
    """Embedded catalog discovery: id -> name and frequency, most frequent first.

    ``name_wins`` 'first' keeps the name of the first document (documents / people
    analyses), 'last' the last one (users analysis). ``array`` reads an array of objects."""
    if array:
        src = docs.select(SEQ, F.explode(V.as_array(V.at(DOC, path))).alias("o"))
    else:
        src = docs.select(SEQ, V.at(DOC, path).alias("o"))
    src = src.where(V.is_object(F.col("o")) & V.truthy(V.at("o", id_field))).select(
        SEQ, V.to_str(V.at("o", id_field)).alias("id"), V.get("o", name_field).alias("name"))
    pick = F.min_by if name_wins == "first" else F.max_by
    return src.groupBy("id").agg(F.count(F.lit(1)).alias("n"), pick("name", SEQ).alias("name"))


def value_frequency(docs: DataFrame, path: str) -> DataFrame:
    """Frequency of the truthy text values at ``path``."""
    v = V.at(DOC, path)
    x = docs.select(F.when(V.is_string(v) & V.truthy(v), V.get(DOC, path)).alias("value"))
    return x.where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def enum_candidates(docs: DataFrame, fields: Sequence[str], max_values: int = 10) -> DataFrame:
    """Distinct values of listed fields; the values are listed only when there are at
    most ``max_values`` (the list is then bounded by construction)."""
    arr = F.array(*[F.struct(F.lit(f).alias(KEY), V.to_str(V.at(DOC, f)).alias("value")) for f in fields])
    vals = docs.select(F.inline(arr)).where(F.col("value").isNotNull()).distinct()
    counts = vals.groupBy(KEY).agg(F.count(F.lit(1)).alias("distinct_values"))
    small = vals.join(counts.where(F.col("distinct_values") <= max_values), KEY).groupBy(KEY).agg(
        F.array_join(F.array_sort(F.collect_list("value")), ",").alias("values"))
    return counts.join(small, KEY, "left")


def fk_candidates(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per candidate foreign-key field: documents where it is truthy, distinct values."""
    texts = docs.select(DOC, *[V.get(DOC, f).alias(f"_text{i}") for i, f in enumerate(fields)])
    arr = F.array(*[F.struct(F.lit(f).alias(KEY), V.truthy_str_at(DOC, f, F.col(f"_text{i}")).alias("value"))
                    for i, f in enumerate(fields)])
    x = texts.select(F.inline(arr))
    return x.groupBy(KEY).agg(F.count("value").alias("present"), F.countDistinct("value").alias("distinct_values"))


# --------------------------------------------------------------------------- G13–G16
def snapshot_keys(docs: DataFrame, fields: Sequence[str] = ("createdBy", "updatedBy")) -> DataFrame:
    """G13 key frequency: how often each key appears inside the audit snapshot objects."""
    arr = F.array(*[F.struct(F.lit(f).alias(KEY), V.at(DOC, f).alias("s")) for f in fields])
    x = docs.select(F.inline(arr)).select(KEY, F.explode(F.map_keys(V.as_object(F.col("s")))).alias("sub_key"))
    return x.groupBy(KEY, "sub_key").agg(F.count(F.lit(1)).alias("n"))


def snapshot_profile(docs: DataFrame, fields: Sequence[str] = ("createdBy", "updatedBy"),
                     user_key: str = "user", id_keys: Sequence[str] = ("id", "_id")) -> DataFrame:
    """Audit snapshots: present (object), with a user, missing, distinct user ids."""
    def uid(s):
        u = V.at(s, user_key)
        ids = [V.at(u, k) for k in id_keys]
        picked = V.coalesce_truthy(*ids) if len(ids) > 1 else ids[0]
        return F.when(V.is_object(u), F.when(V.is_object(picked), V.get(picked, ["$oid"])).otherwise(V.to_str(picked))) \
            .otherwise(V.to_str(u))

    arr = F.array(*[F.struct(F.lit(f).alias(KEY), V.at(DOC, f).alias("s")) for f in fields])
    x = docs.select(F.inline(arr))
    x = x.select(KEY, V.is_object(F.col("s")).alias("is_obj"), V.at("s", user_key).isNotNull().alias("has_user"),
                 uid(F.col("s")).alias("uid"))
    return x.groupBy(KEY).agg(
        F.count_if("is_obj").alias("present"), F.count_if(F.col("is_obj") & F.col("has_user")).alias("with_user"),
        F.count_if(~F.col("is_obj")).alias("missing"),
        F.countDistinct(F.when(F.col("is_obj") & F.col("has_user"), F.col("uid"))).alias("distinct_users"))


def membership_sizes(docs: DataFrame, path: str = "users") -> DataFrame:
    arr = V.as_array(V.at(DOC, path))
    return docs.select(SEQ, F.size(arr).alias("n"), arr.alias("members")).where(F.col("members").isNotNull())


def membership_profile(docs: DataFrame, path: str = "users") -> DataFrame:
    """G14 summary: groups with members, total memberships, distinct members, min/max/avg.

    Sizes count groups that have members. Groups and members are aggregated apart (one row
    each, put together by a last aggregate), so neither makes the other's rows."""
    s = membership_sizes(docs, path).where(F.col("n") > 0)
    groups = s.agg(F.count(F.lit(1)).alias("groups_with_members"), F.sum("n").cast("bigint").alias("memberships"),
                   F.min("n").cast("bigint").alias("min_size"), F.max("n").cast("bigint").alias("max_size"),
                   F.avg("n").alias("avg_size"))
    members = (s.select(F.explode("members").alias("m")).select(V.to_str(F.col("m")).alias("m")).where("m IS NOT NULL")
               .groupBy("m").agg(F.count(F.lit(1)).alias("times")).agg(F.count(F.lit(1)).alias("distinct_members")))
    both = groups.unionByName(members, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("groups_with_members", "memberships", "distinct_members", "min_size",
                                                  "max_size", "avg_size")])


# Membership histogram buckets.
BUCKETS = (("1-5", 1, 5), ("6-10", 6, 10), ("11-20", 11, 20))
BUCKET_OVER = "20+"


def membership_buckets(docs: DataFrame, path: str = "users") -> DataFrame:
    """G14 histogram: groups per size bucket 1-5 / 6-10 / 11-20 / 20+ (groups with members)."""
    s = membership_sizes(docs, path).where(F.col("n") > 0)
    b = None
    for name, lo, hi in BUCKETS:
        cond = (F.col("n") >= lo) & (F.col("n") <= hi)
        b = F.when(cond, F.lit(name)) if b is None else b.when(cond, F.lit(name))
    b = b.otherwise(F.lit(BUCKET_OVER))
    return s.groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("groups"))


def timestamp_format(v: Column) -> Column:
    """Format class of a timestamp value: $date object, ISO Z text, ISO offset text, date text, other."""
    s = V.schema(v)
    t = F.when(s == "STRING", F.try_variant_get(v, "$", "string"))
    return (F.when(F.is_variant_null(v), F.lit("null"))
            .when(V.is_object(v) & V.at(v, ["$date"]).isNotNull(), F.lit("object_date"))
            .when(t.rlike(r"^\d{4}-\d{2}-\d{2}T.*Z$"), F.lit("iso_z"))
            .when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ].*[+-]\d{2}:?\d{2}$"), F.lit("iso_offset"))
            .when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit("date_text"))
            .otherwise(F.lit("other")))


def timestamp_profile(docs: DataFrame, fields: Sequence[str], examples: int = 0) -> DataFrame:
    """Coverage and set of formats of the named timestamp fields; with ``examples``,
    also that many first-seen example values (as JSON text) per field."""
    arr = F.array(*[F.struct(F.lit(f).alias(KEY), V.at(DOC, f).alias("v")) for f in fields])
    x = docs.select(SEQ, F.inline(arr)).where(F.col("v").isNotNull())
    out = x.groupBy(KEY).agg(F.count(F.lit(1)).alias("present"), _types(timestamp_format(F.col("v"))).alias("formats"))
    if examples:
        ex = x.select(KEY, SEQ, F.to_json(F.col("v")).alias("example")).groupBy(KEY, "example").agg(
            F.min(SEQ).alias("first_seq"))
        w = Window.partitionBy(KEY).orderBy("first_seq", "example")
        top = ex.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= examples)
        lists = top.groupBy(KEY).agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "example"))), lambda e: e["example"]), " | ").alias("examples"))
        out = out.join(lists, KEY, "left")
    return out


def timestamp_fields(docs: DataFrame, total: int | None = None) -> DataFrame:
    """Fields whose name contains 'at' or 'date' (any case), with coverage."""
    cov = field_coverage(docs, total)
    return cov.where(F.lower(F.col(KEY)).rlike("at|date")).select(KEY, "present", F.floor("pct").cast("bigint").alias("pct"))


# --------------------------------------------------------------------------- G17–G19
# Dynamic-field detection pattern and the keys it ignores.
DYNAMIC_DETECT = r"^(.+)_(\d+)$"
DYNAMIC_DETECT_IGNORED = ("__v", "_id")
# Names of ``_<n>`` fields and of their values' types.
UNDERSCORE = r"^_\d+$"
UNDERSCORE_TYPES = {"integer": "int", "boolean": "bool", "array": "list"}


def _is_dynamic(name: Column) -> Column:
    return name.contains("_") & name.rlike(DYNAMIC_DETECT) & ~name.isin(*DYNAMIC_DETECT_IGNORED)


def dynamic_detect(docs: DataFrame, examples: int = 2) -> DataFrame:
    """Fields named ``<base>_<n>``: documents with each and its first truthy examples."""
    e = entries(docs).where(_is_dynamic(F.col(KEY)))
    w = Window.partitionBy(KEY).orderBy(SEQ)
    firsts = (e.where(V.truthy(F.col("value"))).select(KEY, SEQ, "value").withColumn("rank", F.row_number().over(w))
              .where(F.col("rank") <= examples).select(KEY, "rank", example_text(F.col("value"), 100).alias("example")))
    lists = firsts.groupBy(KEY).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "example"))), lambda x: x["example"]), " | ").alias("examples"))
    return e.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).join(lists, KEY, "left").select(KEY, "n", "examples")


def dynamic_patterns(docs: DataFrame, top: int = 20) -> DataFrame:
    """Dynamic base names by number of variants (top ``top``)."""
    d = keys(docs).where(_is_dynamic(F.col(KEY))).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    g = d.groupBy(F.regexp_extract(KEY, DYNAMIC_DETECT, 1).alias("base")).agg(
        F.count(F.lit(1)).alias("variants"), F.sum("n").cast("bigint").alias("occurrences"))
    order = [F.col("variants").desc(), F.col("base")]
    w = Window.orderBy(*order)  # over the ``top`` rows that are left
    return g.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(w)).select(
        "base", "variants", "occurrences", F.col("rank").cast("bigint").alias("rank"))


def underscore_fields(docs: DataFrame) -> DataFrame:
    """Fields named ``_<n>``: documents and type set, empty text counting as null."""
    e = entries(docs).where(F.col(KEY).rlike(UNDERSCORE))
    empty = (F.col("kind") == "null") | ((F.col("kind") == "string") & (F.try_variant_get("value", "$", "string") == ""))
    names = F.coalesce(F.when(empty, F.lit("null/empty")), F.element_at(
        F.create_map(*[F.lit(x) for pair in UNDERSCORE_TYPES.items() for x in pair]), F.col("kind")), F.col("kind"))
    return e.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), _types(names).alias("types"))


def underscore_nested(docs: DataFrame) -> DataFrame:
    """Keys inside the objects of ``_<n>`` fields, with the documents that have each."""
    e = entries(docs).where(F.col(KEY).rlike(UNDERSCORE) & (F.col("kind") == "object"))
    keys = e.select(KEY, F.explode(F.map_keys(V.as_object(F.col("value")))).alias("nested_key"))
    return keys.groupBy(KEY, "nested_key").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- G20–G27
def container_profile(docs: DataFrame, container: str, subs: Sequence[str]) -> DataFrame:
    """Per (container, sub-array): documents with data and total items."""
    arr = F.array(*[F.struct(F.lit(s).alias("sub"), V.array_size(DOC, f"{container}.{s}").alias("n"))
                    for s in subs])
    x = docs.select(F.inline(arr))
    return x.groupBy("sub").agg(F.count_if(F.col("n") > 0).alias("docs_with_data"),
                                F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0)).cast("bigint").alias("items")) \
        .select(F.lit(container).alias("container"), "sub", "docs_with_data", "items")


def has_data_docs(docs: DataFrame, field: str, id_col: Column | None = None) -> DataFrame:
    """Documents whose ``field`` has data (recursive emptiness test)."""
    idc = id_col if id_col is not None else V.oid(DOC)
    return docs.select(idc.alias("id"), V.has_data(V.at(DOC, field)).alias("has_data"))


def nonempty_subarray(docs: DataFrame, path: str, id_col: Column | None = None) -> DataFrame:
    """Documents with a non-empty array at ``path``, with its length."""
    idc = id_col if id_col is not None else V.oid(DOC)
    n = F.size(V.as_array(V.at(DOC, path)))
    return docs.select(idc.alias("id"), n.alias("n")).where(F.col("n") > 0)


def access_list_docs(docs: DataFrame, paths: Sequence[str]) -> DataFrame:
    """G23 companion: documents whose access list (array) at each path is non-empty."""
    arr = F.array(*[F.struct(F.lit(p).alias(KEY), F.size(V.as_array(V.at(DOC, p))).alias("n")) for p in paths])
    return docs.select(F.inline(arr)).groupBy(KEY).agg(F.count_if(F.col("n") > 0).alias("docs_with_list"))


def bool_distribution(docs: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Strict true / strict false counts per boolean path (other values ignored)."""
    arr = F.array(*[F.struct(F.lit(p).alias(KEY), V.at(DOC, p).alias("v")) for p in paths])
    x = docs.select(F.inline(arr))
    isb = F.coalesce(V.schema(F.col("v")) == "BOOLEAN", F.lit(False))
    b = F.try_variant_get("v", "$", "boolean")
    return x.groupBy(KEY).agg(F.count_if(isb & b).alias("n_true"), F.count_if(isb & ~b).alias("n_false"))


def nested_distribution(docs: DataFrame, path: str) -> DataFrame:
    """Value distribution of a nested scalar, keyed by its text."""
    x = docs.select(V.to_str(V.at(DOC, path)).alias("value"))
    return x.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def structure_variants(docs: DataFrame) -> DataFrame:
    """Number of distinct key sets per object field; more than one -> JSON candidate."""
    e = entries(docs).where(F.col("kind") == "object")
    sig = F.array_join(F.array_sort(F.map_keys(V.as_object(F.col("value")))), ",")
    g = e.select(KEY, sig.alias("sig")).groupBy(KEY).agg(F.countDistinct("sig").alias("variants"))
    return g.withColumn("json_candidate", F.col("variants") > 1)


# Entities the reference probe looks for in serialised documents, by word.
PROBES = {"user": ("user", "createdby"), "customer": ("customer",)}


def text_reference_probe(docs: DataFrame, probes: dict[str, Sequence[str]] = PROBES) -> DataFrame:
    """Documents whose serialised text contains any word of each entity (any case)."""
    x = docs.select(F.lower(F.to_json(F.col(DOC))).alias("low"))
    def hit(words):
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col("low"), w))
    arr = F.array(*[F.struct(F.lit(k).alias("word"), hit(words).alias("hit")) for k, words in probes.items()])
    return x.select(F.inline(arr)).groupBy("word").agg(F.count_if("hit").alias("n"))


def position_sample(docs: DataFrame, total: int | None = None) -> DataFrame:
    """First, middle (n // 2) and last document by arrival index (dense ``_seq``)."""
    n = total_docs(docs) if total is None else total
    picks = {0: "first", n // 2: "middle", n - 1: "last"}
    label = None
    for p, name in picks.items():
        label = F.when(F.col(SEQ) == p, F.lit(name)) if label is None else label.when(F.col(SEQ) == p, F.lit(name))
    return docs.where(F.col(SEQ).isin(list(picks))).select(label.alias("position"), SEQ, V.oid(DOC).alias("id"))


# --------------------------------------------------------------------------- G28
def schema_recommendation(docs: DataFrame, total: int | None = None, jsonb_keys: int = 3) -> DataFrame:
    """Where each top-level field belongs in the relational model.

    scalar -> main (NOT NULL iff present in every document); array whose items are all
    objects with avg length > 0 -> child_table; object with more than ``jsonb_keys`` keys
    or more than one key set -> jsonb; other objects/arrays -> main (flattened/serialised).
    """
    cov = field_coverage(docs, total)
    arr = array_profile(docs).select(KEY, "avg_len", "item_types")
    e = entries(docs).where(F.col("kind") == "object")
    objs = e.select(KEY, V.as_object(F.col("value")).alias("m")).groupBy(KEY).agg(
        F.max(F.size("m")).alias("max_keys"),
        F.countDistinct(F.array_join(F.array_sort(F.map_keys("m")), ",")).alias("variants"))
    x = cov.join(arr, KEY, "left").join(objs, KEY, "left")
    is_scalar = ~F.col("types").contains("array") & ~F.col("types").contains("object")
    rec = (F.when(is_scalar, F.lit("main"))
           .when((F.col("item_types") == "object") & (F.col("avg_len") > 0), F.lit("child_table"))
           .when((F.col("max_keys") > jsonb_keys) | (F.col("variants") > 1), F.lit("jsonb"))
           .otherwise(F.lit("main")))
    return x.select(KEY, rec.alias("recommendation"),
                    (is_scalar & (F.col("present") == F.col("total"))).alias("not_null"), "present", "types")


def child_table_candidates(docs: DataFrame, min_avg: float = 5) -> DataFrame:
    """G28 flavour: array fields whose average length passes ``min_avg``."""
    return array_profile(docs).where(F.col("avg_len") > min_avg).select(KEY, "avg_len", "docs_with_array")


def optional_fields(docs: DataFrame, total: int | None = None) -> DataFrame:
    """G28 flavour: fields that some document lacks, with their share."""
    return field_coverage(docs, total).where(F.col("present") < F.col("total")).select(KEY, "present", "pct")


def report(docs: DataFrame, total: int | None = None) -> dict[str, DataFrame]:
    """The generic part of a collection analysis (what the per-collection analyzer scripts
    print), as DataFrames keyed by section; ``documents.write_report`` stores each one."""
    total = total_docs(docs) if total is None else total
    return {
        "field_coverage": field_coverage(docs, total),
        "field_examples": field_examples(docs),
        "array_profile": array_profile(docs),
        "array_item_keys": array_item_keys(docs),
        "array_distinct_ids": array_distinct_ids(docs),
        "object_profile": object_profile(docs, with_example=True),
        "structure_variants": structure_variants(docs),
        "snapshot_profile": snapshot_profile(docs),
        "snapshot_keys": snapshot_keys(docs),
        "dynamic_detect": dynamic_detect(docs),
        "dynamic_patterns": dynamic_patterns(docs),
        "underscore_fields": underscore_fields(docs),
        "underscore_nested": underscore_nested(docs),
        "timestamp_fields": timestamp_fields(docs, total),
        "text_reference_probe": text_reference_probe(docs),
        "position_sample": position_sample(docs, total),
        "schema_recommendation": schema_recommendation(docs, total),
    }

"""Declarative collection specs and the normaliser that turns one into DataFrames.

A ``Collection`` names its target schema, its source collection, the parent
collections it depends on, and its ``Table`` list. A table is a row source (the
document itself, an array, an object used as a map, a tagged union of sibling arrays,
an unpivot of sibling objects, an optional sub-object, or an embedded catalog object),
typed columns computed from the row's context, a unique key with a conflict policy,
and parent rules (keep-if-parent, null-if-orphan). Everything is Column expressions;
``normalise`` builds lazy DataFrames, one per table.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import values as V
from ..operators import conflict as U
from ..operators import integrity as R
from ..operators import nested as N

#: Column of a table's rows, on request: (column, raw) of the values that a column's type can't hold.
CAST_ERRORS = "_cast_errors"
SEQ = "_seq"
DOC = "doc"
BATCH_SIZE = 2000  # fixed value: documents per load batch of the source tool


# --------------------------------------------------------------------------- row context
@dataclass
class Ctx:
    """What a column expression may read: the document, the current item (child rows),
    its position / key / tag, and the parent key."""
    doc: Column
    item: Column | None = None
    pos: Column | None = None
    key: Column | None = None
    tag: Column | None = None
    parent: Column | None = None
    run_ts: Column | None = None

    @property
    def src(self) -> Column:
        return self.item if self.item is not None else self.doc


Expr = Callable[[Ctx], Column]


@dataclass(frozen=True)
class Col:
    name: str
    fn: Expr
    dtype: str = "string"
    max_len: int | None = None
    not_null: bool = False


# --------------------------------------------------------------------------- column rules
def _rule(fn: Expr, typed: Callable[[Ctx, str], Column]) -> Expr:
    """A rule that also gives its value in a column's type, without the way over a VARIANT."""
    fn.typed = typed
    return fn


def _text(fn: Expr) -> Expr:
    """A rule whose value is text already."""
    return _rule(fn, lambda c, dtype: fn(c) if dtype == "string" else _as_type(fn(c), dtype))


def g(path: str) -> Expr:
    """``g(p)``: value at path of the row source (item for child rows, else document)."""
    return _rule(lambda c: V.at(c.src, path), lambda c, dtype: V.get(c.src, path, dtype))


def gd(path: str) -> Expr:
    """Value at a path of the **document** (a parent scalar broadcast into child rows)."""
    return _rule(lambda c: V.at(c.doc, path), lambda c, dtype: V.get(c.doc, path, dtype))


def d(path: str, default) -> Expr:
    """``d(p,x)``: default only when missing."""
    return lambda c: F.when(V.at(c.src, path).isNull(), F.lit(default).cast("variant")).otherwise(V.at(c.src, path))


def dd(path: str, default) -> Expr:
    """``d(p,x)`` on the document."""
    return lambda c: F.when(V.at(c.doc, path).isNull(), F.lit(default).cast("variant")).otherwise(V.at(c.doc, path))


def ct(*paths: str) -> Expr:
    """``ct(a,b,...)``: truthy coalesce."""
    return lambda c: V.coalesce_truthy(*[V.at(c.src, p) for p in paths])


def sub(obj: str, key: str) -> Expr:
    """``sub(o,k)``: key of an object (NULL when not an object)."""
    return g(f"{obj}.{key}")


def oid(path: str = "_id") -> Expr:
    return _text(lambda c: V.oid(c.src, path))


def ts(path: str) -> Expr:
    fn = lambda c: V.ts_at(c.src, path)
    return _rule(fn, lambda c, dtype: fn(c) if dtype == "timestamp_ntz" else _as_type(fn(c), dtype))


def ts_fb(primary: str, fallback: str) -> Expr:
    return lambda c: V.ts_with_fallback(c.src, primary, fallback)


def raw_ts(path: str) -> Expr:
    def fn(c: Ctx) -> Column:
        return V.raw_timestamp(c.src, path)

    fn.raw = lambda c: V.at(c.src, path)  # what the cast inside is given
    return fn


def jt(path: str) -> Expr:
    return lambda c: V.json_truthy(V.at(c.src, path))


def jv(path: str) -> Expr:
    return lambda c: V.json_container_at(c.src, path)


def full_name(base: str, first: str = "firstname", last: str = "lastname") -> Expr:
    return _text(lambda c: V.full_name(c.src, first, last, base))


def name_of(base: str) -> Expr:
    """S6 of an object: '' when ``base`` is missing, NULL when it is null or no object."""
    return _text(lambda c: F.when(V.at(c.src, base).isNull() | V.is_object_at(c.src, base), V.full_name(c.src, base=base)))


def str_id(path: str) -> Expr:
    """Id coerced to text (``str(id)``), NULL when missing/null."""
    return _text(lambda c: V.str_at(c.src, path))


def item_str() -> Expr:
    return _text(lambda c: V.to_str(c.item))


def _beside_item(fn: Expr) -> Expr:
    """A rule that does not read the item."""
    fn.beside_item = True
    return fn


def parent() -> Expr:
    return _beside_item(_text(lambda c: c.parent))


def pos() -> Expr:
    return _beside_item(lambda c: c.pos)


def key() -> Expr:
    return _beside_item(_text(lambda c: c.key))


def tag() -> Expr:
    return _beside_item(_text(lambda c: c.tag))


def lit(v) -> Expr:
    return lambda c: F.lit(v)


def flag(path: str, default: bool) -> Expr:
    """P5: boolean option; default when missing or when its parent is not an object."""
    return lambda c: F.when(V.at(c.src, path).isNull(), F.lit(default)).otherwise(V.get(c.src, path, "boolean"))


def dynamic_fixed(keys: tuple[str, ...]) -> Expr:
    return lambda c: N.dynamic_fields_fixed(c.doc, keys)


def dynamic_regex() -> Expr:
    return lambda c: N.dynamic_fields_regex(c.doc)


def audit(name: str) -> Expr:
    """Audit user id computed by the normaliser (``created_by_user_id`` / ``updated_by_user_id``)."""
    return _text(lambda c: F.col(name))


# --------------------------------------------------------------------------- row sources
@dataclass(frozen=True)
class Rows:
    kind: str = "main"              # main | array | map | union | unpivot | one | object
    path: str | None = None
    branches: tuple[tuple[str, str], ...] = ()
    where: Callable[[Ctx], Column] | None = None


def main_rows() -> Rows:
    return Rows("main")


def array(path: str, where=None) -> Rows:
    return Rows("array", path, where=where)


def _is_object(c: Ctx) -> Column:
    return V.is_object(c.item)


def objects(path: str) -> Rows:
    """Array items that are objects."""
    return Rows("array", path, where=_is_object)


def truthy_id(path: str, field_name: str = "id") -> Rows:
    return Rows("array", path, where=lambda c: V.is_object(c.item) & V.truthy_at(c.item, field_name))


def strings(path: str) -> Rows:
    return Rows("array", path, where=lambda c: V.is_string(c.item))


def truthy_items(path: str) -> Rows:
    return Rows("array", path, where=lambda c: V.truthy_at(c.item, "$"))


def map_objects(path: str) -> Rows:
    return Rows("map", path, where=_is_object)


def union(branches: dict[str, str], where=None) -> Rows:
    return Rows("union", branches=tuple(branches.items()),
                where=where or (lambda c: V.is_object(c.item)))


def unpivot(branches: dict[str, str], where=None) -> Rows:
    return Rows("unpivot", branches=tuple(branches.items()), where=where)


def one(path: str) -> Rows:
    return Rows("one", path)


def catalog_object(path: str, id_field: str = "id") -> Rows:
    """Embedded object -> catalog row when it is an object with a truthy id."""
    return Rows("object", path, where=lambda c: V.is_object(c.item) & V.truthy(V.at(c.item, id_field)))


# --------------------------------------------------------------------------- tables
@dataclass(frozen=True)
class ParentRule:
    """J2 (``action='keep'``) or J3 (``action='null'``) against another table."""
    column: str
    table: str               # "<schema>.<table>"
    parent_column: str = "id"
    action: str = "keep"


@dataclass(frozen=True)
class FK:
    columns: tuple[str, ...]
    table: str               # "<schema>.<table>"
    parent_columns: tuple[str, ...] = ("id",)
    on_delete: str = "no action"


@dataclass(frozen=True)
class Table:
    name: str
    rows: Rows
    cols: tuple[Col, ...]
    key: tuple[str, ...] | None = None
    policy: str = "none"     # first | last | first_batched | strict | sync | none
    parents: tuple[ParentRule, ...] = ()
    fks: tuple[FK, ...] = ()
    catalog: bool = False
    sync_by: tuple[str, ...] | None = None   # U6: groups replaced as a whole on incremental loads
    reads_doc: bool = False                  # child columns read document-level values (X9)

    def schema(self) -> list[tuple[str, str]]:
        return [(c.name, c.dtype) for c in self.cols]


@dataclass(frozen=True)
class Collection:
    name: str                    # target schema, e.g. lml_processes
    source: str                  # source collection name
    tables: tuple[Table, ...]
    depends: tuple[str, ...] = ()
    ghosts: str | None = None    # ghost flavour for createdBy / updatedBy (R1, R1b, R2)
    audit: tuple[tuple[str, str], ...] = (("created_by_user_id", "createdBy"), ("updated_by_user_id", "updatedBy"))
    truth_source: bool = False

    def table(self, name: str) -> Table:
        for t in self.tables:
            if t.name == name:
                return t
        raise KeyError(name)

    @property
    def main(self) -> Table:
        return self.table("main")


# --------------------------------------------------------------------------- normalise
@dataclass
class Normalised:
    tables: dict[str, DataFrame]
    rejects: dict[str, DataFrame] = field(default_factory=dict)
    ghosts: DataFrame | None = None
    tracked: dict[str, DataFrame] = field(default_factory=dict)  # tables with CAST_ERRORS besides


def _row_sources(coll: Collection, t: Table, docs: DataFrame, run_ts: Column | None = None) -> tuple[DataFrame, Ctx]:
    """Rows of one table before its columns: keeps ``_seq``, the parent key, ``doc`` where a
    column reads it, and the generator outputs (``pos``/``key``/``tag``/``item``)."""
    pk = coll.main.cols[0]
    r = t.rows
    with_doc = t.reads_doc or r.kind not in ("array", "map", "union")
    base = [F.col(SEQ), *([F.col(DOC)] if with_doc else []), _typed(pk, Ctx(F.col(DOC))).alias("_parent")]
    # of items that are only told to be objects, no copy is made: an empty struct, NULL for others
    kind_only = r.where is _is_object and all(getattr(c.fn, "beside_item", False) for c in t.cols)
    item_type = "struct<>" if kind_only else "variant"
    if r.kind == "array":
        out = N.explode_array(docs, r.path, keep=base, item_type=item_type)
    elif r.kind == "map":
        out = N.explode_object(docs, r.path, keep=base, item_type=item_type).withColumn("pos", F.lit(0))
    elif r.kind == "union":
        out = N.tagged_union(docs, dict(r.branches), keep=base)
    elif r.kind == "unpivot":
        out = N.unpivot_objects(docs, dict(r.branches), keep=base).withColumn("pos", F.lit(0))
    elif r.kind == "one":
        out = N.one_to_one(docs, r.path, keep=base).withColumn("pos", F.lit(0))
    elif r.kind == "object":
        item = V.at(DOC, r.path) if r.path else F.col(DOC)
        out = docs.select(*base, item.alias("item"), F.lit(0).alias("pos"))
    else:
        raise ValueError(r.kind)
    ctx = Ctx(doc=F.col(DOC) if with_doc else F.lit(None).cast("variant"), item=F.col("item"), pos=F.col("pos"),
              key=F.col("key") if "key" in out.columns else None,
              tag=F.col("tag") if "tag" in out.columns else None, parent=F.col("_parent"), run_ts=run_ts)
    if r.where is not None:
        out = out.where(F.col("item").isNotNull() if kind_only else r.where(ctx))
    return out, ctx


def _row_struct(table: str, pos: Column, key: Column | None, tag: Column | None, item: Column) -> Column:
    return F.struct(F.lit(table).alias("_table"), pos.cast("bigint").alias("pos"),
                    (key if key is not None else F.lit(None).cast("string")).alias("key"),
                    (tag if tag is not None else F.lit(None).cast("string")).alias("tag"), item.alias("item"))


def _table_rows(t: Table, doc: Column) -> Column:
    """``array<row>`` of one child table for one document (see ``all_child_rows``)."""
    r = t.rows
    empty_arr = F.array().cast("array<variant>")
    if r.kind == "array":
        arr = F.coalesce(V.as_array(V.at(doc, r.path)), empty_arr)
        return F.transform(arr, lambda x, i: _row_struct(t.name, i, None, None, x))
    if r.kind == "map":
        m = F.coalesce(V.as_object(V.at(doc, r.path)), F.create_map().cast("map<string,variant>"))
        return F.transform(F.map_entries(m), lambda e: _row_struct(t.name, F.lit(0), e["key"], None, e["value"]))
    if r.kind == "union":
        parts = []
        for tg, p in r.branches:
            a = F.coalesce(V.as_array(V.at(doc, p)), empty_arr)
            parts.append(F.transform(a, (lambda tgv: lambda x: F.struct(F.lit(tgv).alias("tag"), x.alias("item")))(tg)))
        allv = F.concat(*parts) if len(parts) > 1 else parts[0]
        return F.transform(allv, lambda x, i: _row_struct(t.name, i, None, x["tag"], x["item"]))
    if r.kind == "unpivot":
        return F.array(*[_row_struct(t.name, F.lit(0), None, F.lit(tg), V.at(doc, p)) for tg, p in r.branches])
    if r.kind in ("one", "object"):
        item = V.at(doc, r.path) if r.path else doc
        return F.array(_row_struct(t.name, F.lit(0), None, None, item))
    raise ValueError(r.kind)


def all_child_rows(coll: Collection, docs: DataFrame) -> DataFrame:
    """Every child-table row of every document in **one** generator over one scan:
    (``_table``, ``_seq``, ``_parent``, pos, key, tag, item). Written partitioned by
    ``_table``, each table then reads only its own rows instead of rescanning documents."""
    pk = coll.main.cols[0]
    doc = F.col(DOC)
    arrays = [_table_rows(t, doc) for t in coll.tables if t.rows.kind != "main"]
    allr = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    out = docs.select(SEQ, _typed(pk, Ctx(doc)).alias("_parent"), F.inline(allr))
    return out


def _rows_from_all(t: Table, allrows: DataFrame, run_ts: Column | None) -> tuple[DataFrame, Ctx]:
    out = allrows.where(F.col("_table") == t.name)
    ctx = Ctx(doc=F.lit(None).cast("variant"), item=F.col("item"), pos=F.col("pos"), key=F.col("key"),
              tag=F.col("tag"), parent=F.col("_parent"), run_ts=run_ts)
    if t.rows.kind in ("unpivot", "one"):
        out = out.where(V.truthy(F.col("item")))
    if t.rows.where is not None:
        out = out.where(t.rows.where(ctx))
    return out, ctx


def normalise(coll: Collection, docs: DataFrame, users: DataFrame | None = None,
              parents: dict[str, DataFrame] | None = None, run_ts: Column | None = None,
              batch_size: int = BATCH_SIZE, rows_path: str | None = None, salt: int = 1,
              materialize: Callable[[DataFrame], DataFrame] | None = None, track_casts: bool = False,
              only: Sequence[str] | None = None, columns: dict[str, Sequence[str]] | None = None) -> Normalised:
    """All tables of a collection as lazy DataFrames (after key policies and parent rules).

    ``docs``     (``_seq``, ``doc``) — the source collection
    ``users``    users.main (``id``) for ghost parents and audit ids, when the spec has ghosts
    ``parents``  other tables named by parent rules, keyed "<schema>.<table>"
    ``run_ts``   load timestamp (ghost rows, S4 defaults); fixed by the caller for repeatable runs
    ``salt``     > 1 salts the parent-rule joins (hot parent keys spread over ``salt`` tasks)
    ``materialize`` applied to the ghost rows before they are used (e.g. a checkpoint), so
                 parent rules and the users merge read them instead of recomputing them
    ``rows_path`` when given, all child rows are generated in one pass over the documents and
                 written there partitioned by table (eager); each child table reads its part.
                 Without it every child table is its own lazy scan of ``docs``.
    ``only``     names of the tables wanted; the plans of the others, which nothing would run, are not made
    ``columns``  per table, the columns that the caller reads, where these are not all: a key policy
                 picks whole rows, through which Spark drops no column that nothing reads
    ``track_casts`` also gives the tables with the column CAST_ERRORS (``tracked``), where a
                 cast can fail; the entries go with their rows through policies and rules
    """
    parents = dict(parents or {})
    run_ts = run_ts if run_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    out: dict[str, DataFrame] = {}
    rejects: dict[str, DataFrame] = {}
    tracked: dict[str, DataFrame] = {}
    ghosts = None
    if coll.ghosts and users is not None:
        ghosts = R.ghost_users(docs, users, flavour=coll.ghosts, run_ts=run_ts)
        if materialize is not None:
            ghosts = materialize(ghosts)
        parents["lml_users.main"] = R.valid_parents(users, ghosts)
    allrows = None
    if rows_path is not None and any(t.rows.kind != "main" and not _needs_doc(t) for t in coll.tables):
        rows_df = all_child_rows(coll, docs)
        rows_df.write.mode("overwrite").option("compression", "zstd").partitionBy("_table").parquet(rows_path)
        # explicit schema: an empty collection writes no partition to infer it from
        allrows = docs.sparkSession.read.schema(rows_df.schema).parquet(rows_path)
    for t in [coll.table(name) for name in only] if only is not None else coll.tables:
        t = _narrowed(t, (columns or {}).get(t.name))
        if t.rows.kind == "main":
            base = docs
            if any(c.name in dict(coll.audit) for c in t.cols) and coll.ghosts:
                base = R.with_audit_ids(docs, dict(coll.audit), flavour=coll.ghosts)
            ctx = Ctx(doc=F.col(DOC), run_ts=run_ts)
            errors = _cast_errors(t.cols, ctx) if track_casts else []
            df = base.select(SEQ, F.lit(0).alias("pos"), *[_col(c, ctx) for c in t.cols], *errors)
        elif allrows is not None and not _needs_doc(t):
            rows, ctx = _rows_from_all(t, allrows, run_ts)
            errors = _cast_errors(t.cols, ctx) if track_casts else []
            df = rows.select(SEQ, F.col("pos").cast("bigint").alias("pos"), *[_col(c, ctx) for c in t.cols], *errors)
        else:
            rows, ctx = _row_sources(coll, t, docs, run_ts)
            errors = _cast_errors(t.cols, ctx) if track_casts else []
            df = rows.select(SEQ, F.col("pos").cast("bigint").alias("pos"), *[_col(c, ctx) for c in t.cols], *errors)
        # A rule commutes with the key policy when it keeps rows by a key column (all rows
        # of a key pass or fail together) or nulls a non-key column; those run after the
        # policy, on the (smaller) deduplicated rows, and the policy's double read of its
        # input then does not repeat the parent join.
        key = set(t.key or ())
        pre = [r for r in t.parents if not ((r.action == "keep") == (r.column in key))]
        post = [r for r in t.parents if r not in pre]
        df = _apply_rules(df, pre, parents, salt)
        df, rej = apply_policy(df, t, batch_size)
        df = _apply_rules(df, post, parents, salt)
        if rej is not None:
            rej = _apply_rules(rej, post, parents, salt)
        out[t.name] = df.select(*[c.name for c in t.cols])
        if errors:
            tracked[t.name] = df.select(*[c.name for c in t.cols], CAST_ERRORS)
        if rej is not None:
            rejects[t.name] = rej.drop(CAST_ERRORS)
    return Normalised(out, rejects, ghosts, tracked)


def _apply_rules(df: DataFrame, rules, parents: dict[str, DataFrame], salt: int) -> DataFrame:
    for rule in rules:
        p = parents.get(rule.table)
        if p is None:  # a rule that is left out would keep rows without a parent
            raise ValueError(f"parent table {rule.table} of rule on {rule.column} is not given")
        if rule.action == "keep":
            df = R.keep_if_parent(df, rule.column, p, rule.parent_column, salt=salt)
        else:
            df = R.null_if_orphan(df, rule.column, p, rule.parent_column, salt=salt)
    return df


def _narrowed(t: Table, wanted: Sequence[str] | None) -> Table:
    """The table with the wanted columns alone, and those that its policy and parent rules read."""
    if wanted is None:
        return t
    read = {*wanted, *(t.key or ()), *(r.column for r in t.parents)}
    return replace(t, cols=tuple(c for c in t.cols if c.name in read))


def _needs_doc(t: Table) -> bool:
    """Child tables whose columns read the document itself (a parent scalar broadcast into
    child rows, X9) keep their own scan; all others come from the single-pass row table."""
    return t.reads_doc


def _col(c: Col, ctx: Ctx) -> Column:
    if c.dtype == "variant":
        return c.fn(ctx).alias(c.name)
    return _typed(c, ctx).alias(c.name)


def _typed(c: Col, ctx: Ctx) -> Column:
    typed = getattr(c.fn, "typed", None)
    return typed(ctx, c.dtype) if typed is not None else _as_type(c.fn(ctx), c.dtype)


def _as_type(v: Column, dtype: str) -> Column:
    """Rules return VARIANT (paths) or typed values (ids, names, timestamps, positions).
    Casting to VARIANT is a no-op for the first and wraps the second, so one
    ``try_variant_get`` types both with variant cast rules (NULL when not castable)."""
    return F.try_variant_get(v.cast("variant"), "$", dtype)


def _cast_errors(cols: Sequence[Col], ctx: Ctx) -> list[Column]:
    """V6 / S5 of a load: an entry (column, raw JSON) for every value that is there, not null,
    and lost by its column's type. Nothing for a table whose columns are all text."""
    found = []
    for c in cols:
        if c.dtype in ("string", "variant"):
            continue
        raw = getattr(c.fn, "raw", c.fn)(ctx).cast("variant")
        lost = raw.isNotNull() & ~V.is_null(raw) & _typed(c, ctx).isNull()
        found.append(F.when(lost, F.struct(F.lit(c.name).alias("column"), F.to_json(raw).alias("raw"))))
    return [F.filter(F.array(*found), lambda e: e.isNotNull()).alias(CAST_ERRORS)] if found else []


def apply_policy(df: DataFrame, t: Table, batch_size: int = BATCH_SIZE) -> tuple[DataFrame, DataFrame | None]:
    """Key-conflict policy of a table: (rows kept, rejects or None)."""
    if not t.key or t.policy in ("none", "sync"):
        return df, None
    key = list(t.key)
    if t.policy == "first":
        return U.dedupe(df, key, keep="first", seq=[SEQ, "pos"]), None
    if t.policy == "last":
        return U.dedupe(df, key, keep="last", seq=[SEQ, "pos"]), None
    if t.policy == "first_batched":
        # per-batch last-wins dedupe, then first-wins insert across batches (U3+U2)
        ordered = df.withColumn("_nb", -F.floor(F.col(SEQ) / F.lit(batch_size)))
        return U.dedupe(ordered, key, keep="last", seq=["_nb", SEQ, "pos"]).drop("_nb"), None
    if t.policy == "strict":
        acc, rej = U.strict_insert(df, key, order=[SEQ, "pos"])
        return acc, rej
    raise ValueError(t.policy)

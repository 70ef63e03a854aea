"""Key-conflict resolution (U1–U8) as set operations.

Every dedupe is a hash aggregate (``max_by`` / ``min``) so Spark pre-aggregates on the
map side: a key that holds a third of all rows collapses to one row per map partition
before the shuffle. No operator here sorts a whole key group in one task.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import keyed_side

SEQ = "_seq"
REJECT_REASON = "reject_reason"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def has_null_key(key: str | Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in _keys(key):
        cond = cond | F.col(k).isNull()
    return cond


def _pick(df: DataFrame, key: Sequence[str], order: Column, extra_group: Column | None = None,
          order_cols: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row with the largest ``order`` (a struct of orderable fields).
    ``extra_group`` (NULL for ordinary rows) splits rows that must not conflict. The columns that
    ``order`` is made of are picked on their own: a caller that drops them does not shuffle them twice."""
    others = [c for c in df.columns if c not in key]
    groups = [F.col(c) for c in key] + ([extra_group.alias("_nk")] if extra_group is not None else [])
    if not others:
        return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).select(*key)
    held = {"_place": [c for c in others if c in order_cols], "_row": [c for c in others if c not in order_cols]}
    picked = df.groupBy(*groups).agg(*[F.max_by(F.struct(*cols), order).alias(name) for name, cols in held.items() if cols])
    return picked.select(*key, *[F.col(name)[c].alias(c) for name, cols in held.items() for c in cols])


def order_key(order: Sequence[str]) -> Column:
    """Total order of rows as one value. One or two non-negative integer columns (``_seq``,
    array ``pos``) are packed into DECIMAL(38,0), which hash aggregation can keep as a
    mutable buffer (a struct would force a sort-based aggregate)."""
    cols = list(order)
    if len(cols) == 1:
        return F.col(cols[0]).cast("decimal(38,0)")
    if len(cols) == 2:
        return (F.col(cols[0]).cast("decimal(38,0)") * F.lit(10 ** 18).cast("decimal(38,0)")
                + F.col(cols[1]).cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.struct(*[F.col(c) for c in cols])


def dedupe(
    df: DataFrame,
    key: str | Sequence[str],
    keep: str = "last",
    seq: str | Sequence[str] = SEQ,
    batch_size: int | None = None,
    null_keys_conflict: bool = False,
) -> DataFrame:
    """One row per key.

    keep='last'  U1/U3: the row with the highest ``seq`` wins.
    keep='first' U2:    the row with the lowest ``seq`` wins.
    batch_size   U3+U2: the **last** row of the **first** batch (``seq // batch_size``)
                 that holds the key wins, which is what per-batch last-wins dedupe
                 followed by first-wins insert produces. ``seq`` must be the dense arrival
                 index (0, 1, 2, ...), as ``read_documents`` assigns it.
    U5: rows with a NULL key part never conflict and are all kept, unless
    ``null_keys_conflict`` (then NULLs group together like ``dropDuplicates``).
    """
    k = _keys(key)
    if not isinstance(seq, str):
        s = F.struct(*[F.col(c) for c in seq])
        if batch_size:
            raise ValueError("batch_size needs a single dense seq column")
        order = s if keep == "last" else None
        if keep == "first":
            # smallest struct first: max_by over the negated components
            order = F.struct(*[(-F.col(c)).alias(c) for c in seq])
        return _dedupe_with(df, k, order, null_keys_conflict, seq)
    s = F.col(seq)
    if batch_size:
        order = F.struct((-F.floor(s / F.lit(batch_size))).alias("b"), s.alias("s"))
    elif keep == "last":
        order = s
    elif keep == "first":
        order = -s
    else:
        raise ValueError(keep)
    return _dedupe_with(df, k, order, null_keys_conflict, [seq])


def _dedupe_with(df: DataFrame, k: list[str], order: Column, null_keys_conflict: bool,
                 order_cols: Sequence[str] = (SEQ,)) -> DataFrame:
    if null_keys_conflict:
        return _pick(df, k, order, order_cols=order_cols).select(*df.columns)
    # U5 in the same pass: a row with a NULL key part is its own group
    guard = F.when(has_null_key(k), F.struct(*[F.col(c) for c in order_cols]))
    return _pick(df, k, order, guard, order_cols).select(*df.columns)


def upsert(target: DataFrame, incoming: DataFrame, key: str | Sequence[str], policy: str = "last",
           seq: str = SEQ, batch_size: int | None = None) -> DataFrame:
    """Apply incoming rows to a target table.

    policy='last'  U1 ``ON CONFLICT DO UPDATE``: incoming replaces the target row.
    policy='first' U2 ``ON CONFLICT DO NOTHING``: the existing row is kept.
    Incoming duplicates are resolved first with ``dedupe`` (U3; ``batch_size`` for U3+U2).
    Rows whose key has a NULL part never conflict (U5).
    """
    k = _keys(key)
    cols = [c for c in target.columns]
    inc = dedupe(incoming, k, keep="last" if policy == "last" else "first", seq=seq, batch_size=batch_size)
    inc = inc.select(*cols)
    inc_keyed = inc.where(~has_null_key(k))
    if policy == "last":
        survivors = target.join(keyed_side(inc_keyed.select(*k)), on=k, how="left_anti")
        return survivors.unionByName(inc)
    if policy == "first":
        fresh = inc.join(keyed_side(target.where(~has_null_key(k)).select(*k)), on=k, how="left_anti")
        return target.unionByName(fresh)
    raise ValueError(policy)


def strict_insert(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str] = SEQ,
                  existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """U4: a plain INSERT under a unique key. Returns ``(accepted, rejects)``.

    The first row of a key in ``order`` (e.g. ``['_seq', 'pos']``) is accepted unless the
    key already exists in ``existing``; the rest go to ``rejects`` with
    ``reject_reason='duplicate_key'``. Rows with a NULL key part are always accepted (U5).
    The first row per key comes from a partial aggregate (``min`` of the order struct)
    joined back on (key, order), a join key that is unique per row, so a hot key does
    not land in one task.
    """
    k = _keys(key)
    o = _keys(order)
    ok_col = order_key(o)
    firsts = df.where(~has_null_key(k)).groupBy(*k).agg(F.min(ok_col).alias("_ok")).withColumn("_first", F.lit(True))
    marked = df.withColumn("_ok", ok_col).join(keyed_side(firsts), on=[*k, "_ok"], how="left")
    if existing is not None:
        marked = marked.join(
            keyed_side(existing.select(*k).where(~has_null_key(k)).dropDuplicates(k).withColumn("_exists", F.lit(True))),
            on=k, how="left")
        ok = (F.col("_first").isNotNull() & F.col("_exists").isNull()) | has_null_key(k)
    else:
        ok = F.col("_first").isNotNull() | has_null_key(k)
    accepted = marked.where(ok).select(*df.columns)
    rejects = marked.where(~ok).select(*df.columns).withColumn(REJECT_REASON, F.lit("duplicate_key"))
    return accepted, rejects


def sync_members(target: DataFrame, incoming: DataFrame, group_key: str | Sequence[str],
                 present: DataFrame | None = None) -> DataFrame:
    """Every group present in the batch is replaced by its incoming rows.

    ``present`` lists the group keys of the incoming documents (a group whose document
    arrives with no members is emptied); by default the groups seen in ``incoming``.
    """
    g = _keys(group_key)
    groups = (present if present is not None else incoming).select(*g)
    return target.join(keyed_side(groups), on=g, how="left_anti").unionByName(incoming.select(*target.columns))


def full_refresh(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """U7 for one table: the result is the incoming rows only (overwrite)."""
    return incoming.select(*target.columns)


def refresh_closure(fks: Sequence[tuple[str, str]], root: str) -> list[str]:
    """Tables emptied by a full refresh of ``root``: root and every table that reaches
    it through foreign keys (``fks`` = (child_table, parent_table) edges). Catalog parents
    of ``root`` are not in the closure, so stale catalog rows survive (Q16)."""
    children: dict[str, set[str]] = {}
    for c, p in fks:
        children.setdefault(p, set()).add(c)
    out, todo = [], [root]
    while todo:
        t = todo.pop()
        if t in out:
            continue
        out.append(t)
        todo.extend(sorted(children.get(t, ())))
    return out


def reset_all(spark, schemas: Sequence[str]) -> list[str]:
    """U8: drop every collection schema (the list comes from the collection config)."""
    for s in schemas:
        spark.sql(f"DROP DATABASE IF EXISTS `{s}` CASCADE")
    return list(schemas)

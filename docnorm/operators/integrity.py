"""Referential integrity as joins (J1–J4) and ghost parents.

The source keeps parent key sets in memory and tests membership row by row; here every
membership test is a sort-merge join whose skewed partitions AQE splits
(``spark.sql.adaptive.skewJoin.enabled``). No key set goes through the driver: its size
as estimated from compressed files says little about its rows (``session.keyed_side``).
"""
from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import values as V
from ..session import keyed_side

SEQ = "_seq"


# --------------------------------------------------------------------------- J1–J4
def key_set(parent: DataFrame, col: str, alias: str | None = None, distinct: bool = False) -> DataFrame:
    """The non-NULL key column of a parent table (optionally distinct)."""
    out = parent.select(F.col(col).alias(alias or col)).where(F.col(alias or col).isNotNull())
    return out.distinct() if distinct else out


def _join_parent(child: DataFrame, col: str, keys: DataFrame, how: str, salt: int) -> DataFrame:
    """Join child rows to a parent key set (column ``_pk``).

    ``salt`` > 1 spreads every key over ``salt`` tasks: the child side gets a salt from a
    hash of its row (deterministic, so a recomputed task gives the same rows) and the key
    set is replicated once per salt value with a generator (one row per key and salt).
    Use it when one key may hold a large share of the child rows and AQE skew handling is
    off; by default AQE splits skewed partitions itself."""
    if salt <= 1:
        return child.join(keyed_side(keys), child[col] == keys["_pk"], how)
    salted = child.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in child.columns]), F.lit(salt)))
    rep = keys.select("_pk", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_psalt"))
    cond = (salted[col] == rep["_pk"]) & (salted["_salt"] == rep["_psalt"])
    out = salted.join(keyed_side(rep), cond, how)
    return out.drop("_salt", "_psalt")


def keep_if_parent(child: DataFrame, col: str, parent: DataFrame, parent_col: str, salt: int = 1) -> DataFrame:
    """Child rows whose ``col`` exists in the parent (left semi join; NULL never matches)."""
    keys = key_set(parent, parent_col, "_pk", distinct=salt > 1)
    return _join_parent(child, col, keys, "left_semi", salt)


def null_if_orphan(child: DataFrame, col: str, parent: DataFrame, parent_col: str, salt: int = 1) -> DataFrame:
    """Keep every child row; set ``col`` to NULL when it has no parent.

    Rows without a key match nothing; a second join key, a hash of their row, spreads them
    over the tasks instead of letting them meet in one."""
    keys = key_set(parent, parent_col, "_pk", distinct=True).withColumn("_pn", F.lit(0).cast("bigint"))
    row_hash = F.xxhash64(*[F.col(c) for c in child.columns])
    keyed = child.withColumn("_n", F.when(F.col(col).isNull(), row_hash).otherwise(F.lit(0)))
    if salt > 1:
        keyed = keyed.withColumn("_n", F.when(F.col(col).isNull(), row_hash).otherwise(F.pmod(row_hash, F.lit(salt))))
        keys = keys.withColumn("_pn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
    joined = keyed.join(keyed_side(keys), (keyed[col] == keys["_pk"]) & (keyed["_n"] == keys["_pn"]), "left")
    return joined.select(*[F.when(F.col("_pk").isNotNull(), F.col(c)).alias(c) if c == col else F.col(c)
                           for c in child.columns])


def orphans(child: DataFrame, col: str, parent: DataFrame, parent_col: str, salt: int = 1) -> DataFrame:
    """Child rows with a non-NULL ``col`` that has no parent (left anti join)."""
    keys = key_set(parent, parent_col, "_pk", distinct=salt > 1)
    return _join_parent(child.where(F.col(col).isNotNull()), col, keys, "left_anti", salt)


# --------------------------------------------------------------------------- R1–R3
# Ghost user defaults per flavour.
GHOST_FIRSTNAME = "Restored"
GHOST_LASTNAME = "User"
PT_GHOST_FIRSTNAME = "Ghost"
PT_GHOST_LASTNAME = "User"
PT_GHOST_EMAIL_DOMAIN = "@ghost.local"
MIN_USER_ID_LEN = 5

FLAVOURS = ("standard", "groups", "processtypes")


def _scalar_kind(v: Column) -> Column:
    return F.when(~V.is_object(v) & ~V.is_array(v), V.schema(v))


FENCE = "_fence"


def _fence() -> Column:
    """A non-deterministic column in the last projection of a staged extraction.

    Filters on its outputs then stay above it instead of being pushed down with every
    stage substituted into the predicate (which multiplies the expression size)."""
    return F.spark_partition_id().alias(FENCE)


_NAME_KEYS = ("firstname", "firstName", "lastname", "lastName", "username", "userName", "email")


def snapshot_users(df: DataFrame, snap: str, flavour: str = "standard", keep: Sequence[str] = (),
                   prefix: str = "", require_id: bool = False) -> DataFrame:
    """Adds ``<prefix>id, firstname, lastname, email, username`` for the audit snapshot in
    VARIANT column ``snap`` (``createdBy`` / ``updatedBy``); ``id`` is NULL when the snapshot
    names nobody.

    standard (R1): snapshot must be a non-empty object; ``user`` is text/integer (id only,
      names NULL) or an object with id = ct(id, _id), ``$oid`` unwrapped; falsy ids and
      ids shorter than 5 characters are dropped; names fall back to camelCase keys and
      then to 'Restored' / 'User'. Booleans are not ids.
    groups (R1b): as standard without the camelCase fallbacks.
    processtypes (R2): ``user`` must be a non-empty object with a truthy ``id``; no length
      rule; missing names default to 'Ghost' / 'User', missing email to '<id>@ghost.local'.

    Evaluated in three narrow projections (snapshot -> user -> fields) so that every
    intermediate VARIANT is extracted once per row.
    """
    if flavour not in FLAVOURS:
        raise ValueError(flavour)
    keep = list(keep)
    sn = F.col(snap)
    s1 = df.select(*keep, F.when(V.is_object(sn) & V.truthy(sn), V.at(sn, "user")).alias("_user"))
    user = F.col("_user")
    s2 = s1.select(*keep, "_user", V.is_object(user).alias("_uobj"), _scalar_kind(user).alias("_ukind"),
                   V.at(user, "id").alias("_idv"), V.at(user, "_id").alias("_idv2"),
                   *[V.at(user, k).alias(f"_n_{i}") for i, k in enumerate(_NAME_KEYS)])
    uobj = F.col("_uobj")

    def n(k):
        # Spark column names are case-insensitive: name the extracted keys by position
        return F.col(f"_n_{_NAME_KEYS.index(k)}")

    if flavour == "processtypes":
        idv = F.col("_idv")
        uid = F.when(uobj & V.truthy(user) & V.truthy(idv), V.to_str(idv))
        s3 = s2.select(*keep, uid.alias("_uid"), *[F.col(c) for c in s2.columns if c.startswith("_n_")])
        uid = F.col("_uid")
        out = s3.select(
            *keep, uid.alias(prefix + "id"), _fence(),
            F.when(uid.isNotNull(), F.when(n("firstname").isNull(), F.lit(PT_GHOST_FIRSTNAME))
                   .otherwise(F.try_variant_get(n("firstname"), "$", "string"))).alias(prefix + "firstname"),
            F.when(uid.isNotNull(), F.when(n("lastname").isNull(), F.lit(PT_GHOST_LASTNAME))
                   .otherwise(F.try_variant_get(n("lastname"), "$", "string"))).alias(prefix + "lastname"),
            F.when(uid.isNotNull(), F.when(n("email").isNull(), F.concat(uid, F.lit(PT_GHOST_EMAIL_DOMAIN)))
                   .otherwise(F.try_variant_get(n("email"), "$", "string"))).alias(prefix + "email"),
            F.when(uid.isNotNull(), F.try_variant_get(n("username"), "$", "string")).alias(prefix + "username"))
        return _finish(out, prefix, require_id)
    scalar_id = F.when(F.col("_ukind").isin("STRING", "BIGINT", "INT", "SMALLINT", "TINYINT"), V.to_str(user))
    obj_id = V.coalesce_truthy(F.col("_idv"), F.col("_idv2"))
    s3 = s2.select(*keep, "_uobj", scalar_id.alias("_sid"), obj_id.alias("_oid"),
                   *[F.col(c) for c in s2.columns if c.startswith("_n_")])
    oid = F.col("_oid")
    oid = F.when(V.is_object(oid), V.at(oid, ["$oid"])).otherwise(oid)
    if flavour == "standard":
        fv = V.coalesce_truthy(n("firstname"), n("firstName"))
        lv = V.coalesce_truthy(n("lastname"), n("lastName"))
        uv = V.coalesce_truthy(n("username"), n("userName"))
    else:
        fv, lv, uv = n("firstname"), n("lastname"), n("username")
    s4 = s3.select(*keep, "_uobj", "_sid", oid.alias("_oid2"), fv.alias("_fv"), lv.alias("_lv"), uv.alias("_uv"),
                   n("email").alias("_ev"))
    o2 = F.col("_oid2")
    raw = F.when(uobj, F.when(V.truthy(o2), V.to_str(o2))).otherwise(F.col("_sid"))
    uid = F.when(V.truthy_str(raw) & (F.length(raw) >= MIN_USER_ID_LEN), raw)

    def tx(v):
        return F.try_variant_get(v, "$", "string")

    first, last, username = tx(F.col("_fv")), tx(F.col("_lv")), tx(F.col("_uv"))
    first_ok, last_ok = V.truthy(F.col("_fv")), V.truthy(F.col("_lv"))
    s5 = s4.select(*keep, uid.alias("_uid"), "_uobj", first.alias("_f"), first_ok.alias("_fok"), last.alias("_l"),
                   last_ok.alias("_lok"), tx(F.col("_ev")).alias("_e"), username.alias("_u"))
    uid = F.col("_uid")
    ok = uid.isNotNull() & F.col("_uobj")
    out = s5.select(
        *keep, uid.alias(prefix + "id"), _fence(),
        F.when(ok, F.when(F.col("_fok"), F.col("_f")).otherwise(F.lit(GHOST_FIRSTNAME))).alias(prefix + "firstname"),
        F.when(ok, F.when(F.col("_lok"), F.col("_l")).otherwise(F.lit(GHOST_LASTNAME))).alias(prefix + "lastname"),
        F.when(ok, F.col("_e")).alias(prefix + "email"),
        F.when(ok, F.col("_u")).alias(prefix + "username"))
    return _finish(out, prefix, require_id)


def _finish(out: DataFrame, prefix: str, require_id: bool) -> DataFrame:
    if require_id:
        # the predicate also reads the fence, so it cannot be pushed below the last stage
        out = out.where(F.col(prefix + "id").isNotNull() & (F.col(FENCE) >= 0))
    return out.drop(FENCE)


def with_audit_ids(df: DataFrame, columns: dict[str, str], flavour: str = "standard", doc: str = "doc") -> DataFrame:
    """``cu`` / ``uu``: add one id column per snapshot path (ghost or existing user).

    A text of ``user.id`` that only a truthy scalar has is the id; ``snapshot_users`` looks at
    the other snapshots."""
    out = df
    shortest = 1 if flavour == "processtypes" else MIN_USER_ID_LEN
    for name, path in columns.items():
        text = out.withColumn("_text", V.get(doc, f"{path}.user.id"))
        plain = text.withColumn("_plain", V.plain_text(F.col("_text")))
        base = plain.withColumn("_snap", F.when(F.col("_plain"), F.lit(None)).otherwise(V.at(doc, path)))
        ids = snapshot_users(base, "_snap", flavour, keep=[*out.columns, "_text", "_plain"], prefix="_a_")
        long_enough = F.when(F.length("_text") >= shortest, F.col("_text"))
        out = ids.select(*out.columns, F.when(F.col("_plain"), long_enough).otherwise(F.col("_a_id")).alias(name))
    return out


def snapshots(docs: DataFrame, paths: Sequence[str] = ("createdBy", "updatedBy"), flavour: str = "standard",
              doc: str = "doc", seq: str = SEQ) -> DataFrame:
    """One row per (document, snapshot slot) that names a user: seq, slot, id, names."""
    arr = F.array(*[F.struct(F.lit(i).alias("slot"), V.at(doc, p).alias("snap")) for i, p in enumerate(paths)])
    s = docs.select(F.col(seq), F.inline(arr))
    return snapshot_users(s, "snap", flavour, keep=[seq, "slot"], require_id=True)


def ghost_users(docs: DataFrame, users: DataFrame, flavour: str = "standard",
                paths: Sequence[str] = ("createdBy", "updatedBy"), run_ts: Column | None = None,
                user_id_col: str = "id", doc: str = "doc", seq: str = SEQ) -> DataFrame:
    """Users that snapshots name but ``users`` lacks, one row per id, the
    **first** snapshot seen (document order, createdBy before updatedBy) giving the names.

    Columns: id, firstname, lastname, email, username, deleted (TRUE), created_at, updated_at.
    The first snapshot per id is a ``min_by`` hash aggregate (map-side partial), so a user
    named by a third of all documents costs one row per map partition in the shuffle.
    """
    snaps = snapshots(docs, paths, flavour, doc, seq)
    firsts = snaps.groupBy("id").agg(
        F.min_by(F.struct("firstname", "lastname", "email", "username"), F.struct(seq, "slot")).alias("_u"))
    known = key_set(users, user_id_col, "_uid")
    missing = firsts.join(keyed_side(known), firsts["id"] == known["_uid"], "left_anti")
    ts = run_ts if run_ts is not None else F.lit(None).cast("timestamp_ntz")
    return missing.select(
        "id", "_u.firstname", "_u.lastname", "_u.email", "_u.username",
        F.lit(True).alias("deleted"), ts.cast("timestamp_ntz").alias("created_at"),
        ts.cast("timestamp_ntz").alias("updated_at"))


def valid_parents(users: DataFrame, ghosts: DataFrame, col: str = "id") -> DataFrame:
    """Parent key set = existing users ∪ ghosts of the same run (order-free)."""
    return users.select(F.col(col).alias("id")).unionByName(ghosts.select("id"))


# --------------------------------------------------------------------------- R4, R5
def dependency_check(parents: dict[str, DataFrame]) -> DataFrame:
    """One row per parent table: (collection, row_count, ok) with ok = row_count > 0."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("collection"), "row_count")
             for name, df in parents.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("ok", F.col("row_count") > 0)


def load_order(depends: dict[str, Sequence[str]]) -> list[str]:
    """A topological order of collections (parents before children), ties by name."""
    order: list[str] = []
    temp: set[str] = set()

    def visit(n: str):
        if n in order:
            return
        if n in temp:
            raise ValueError(f"dependency cycle at {n}")
        temp.add(n)
        for p in sorted(depends.get(n, ())):
            visit(p)
        temp.discard(n)
        order.append(n)

    for n in sorted(depends):
        visit(n)
    return order

"""Driver queries: nested collections built from the driver tables, normalised with the
library's operators. Each query has an oracle in ``oracle.py`` that computes the same
rows straight from the flat tables with plain SQL.

Conventions: ids are text, counts/keys BIGINT, timestamps rendered as
``yyyy-MM-dd HH:mm:ss.SSSSSS`` text (zone-less UTC), every column aliased.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import values as V
from ..operators import conflict as U
from ..operators import integrity as R
from ..operators import nested as N
from ..sources import nest
from ..sources.documents import FENCE

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
RUN_TS = "2030-01-01 00:00:00"
BATCH = 2000


def tstr(c: Column) -> Column:
    return V.ts_string(c)


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def orders_docs(spark: SparkSession, d: str) -> DataFrame:
    return nest.docs(spark, d, "orders")


def users_docs(spark: SparkSession, d: str) -> DataFrame:
    return nest.docs(spark, d, "users")


def _pid(name: str = "process_id") -> Column:
    return V.oid("doc").alias(name)


def users_main_ids(spark: SparkSession, d: str) -> DataFrame:
    return users_docs(spark, d).select(V.oid("doc").alias("id"))


def members(spark: SparkSession, d: str) -> DataFrame:
    """Group members (strings, falsy dropped) with their array position."""
    m = N.explode_array(orders_docs(spark, d), "users", keep=[F.col("_seq"), _pid("group_id")])
    return m.where(V.is_string(F.col("item")) & V.truthy(F.col("item"))).select(
        "_seq", "group_id", F.col("pos").cast("bigint").alias("pos"), V.to_str(F.col("item")).alias("user_id"))


# --------------------------------------------------------------------------- A/P/S
def main_projection(spark, d):
    return orders_docs(spark, d).select(
        _pid(),
        V.get("doc", "processNumber", "bigint").alias("process_number"),
        V.get("doc", "processTypeName").alias("process_type_name"),
        V.get("doc", "processTypeId").alias("process_type_id"),
        V.get("doc", "customerId", "bigint").alias("customer_id"),
        V.get("doc", "lumbreStatusName").alias("lumbre_status_name"),
        V.get("doc", "deleted", "boolean").alias("deleted"),
        V.get("doc", "totalPrice", "double").alias("total_price"),
        V.sub("doc", "processStarter", "id", "bigint").alias("starter_id"),
        V.sub("doc", "processStarter", "name").alias("starter_name"),
        V.sub("doc", "processStarter", "starterType").alias("starter_type"),
    )


def timestamp_formats(spark, d):
    docs = orders_docs(spark, d)
    created = V.ts_at("doc", "createdAt")
    c4 = F.coalesce(created, run_ts())
    return docs.select(
        _pid(),
        tstr(created).alias("created_at"),
        tstr(V.ts_at("doc", "updatedAt")).alias("updated_at"),
        tstr(V.ts_with_fallback("doc", "createdAt", "created_at")).alias("created_fallback"),
        tstr(V.raw_timestamp("doc", "processDate")).alias("process_date"),
        tstr(c4).alias("created_or_run"),
        tstr(F.coalesce(V.ts_at("doc", "created_at"), c4)).alias("updated_or_created"),
    )


def truthy_defaults(spark, d):
    return users_docs(spark, d).select(
        V.oid("doc").alias("user_id"),
        V.default_if_missing("doc", "deleted", "boolean", False).alias("deleted"),
        V.ct("doc", ["customer_id", "customerId"], "bigint").alias("customer_id"),
        V.ct("doc", ["lumbre_version", "lumbreVersion"], "bigint").alias("lumbre_version"),
        V.sub("doc", "role", "id").alias("role_id"),
        V.get("doc", "username").alias("username"),
        V.flag("doc", "area.isTable", True).alias("mode_table"),
        V.flag("doc", "subarea.isMap", False).alias("mode_map"),
    )


def json_forms(spark, d):
    docs = orders_docs(spark, d)

    def both(path, name):
        v = V.at("doc", path)
        return [V.json_text(V.json_truthy(v)).alias("jt_" + name), V.json_text(V.json_container(v)).alias("jv_" + name)]

    return docs.select(_pid(), *both("lumbreNextReviewer", "reviewer"), *both("extra_9", "extra"),
                       *both("zero_2", "zero"), *both("obj_8", "obj"), *both("recipients.emails", "emails"),
                       *both("processStarter", "starter"))


def _last_movements(spark, d):
    lm = N.one_to_one(orders_docs(spark, d), "lastMovement", keep=[_pid()])
    it = F.col("item")
    return lm.select(
        "process_id",
        V.get(it, "origin.user.id").alias("origin_user_id"),
        V.full_name(V.at(it, "origin.user")).alias("origin_user_name"),
        V.get(it, "destination.user.id").alias("destination_user_id"),
        V.full_name(V.at(it, "destination.user")).alias("destination_user_name"),
        V.get(it, "destination.user.area.name").alias("destination_area_name"),
        V.get(it, "destination.user.subarea.name").alias("destination_subarea_name"),
    )


def full_name(spark, d):
    return _last_movements(spark, d).select("process_id", "origin_user_name", "destination_user_name")


def optional_one_to_one(spark, d):
    return _last_movements(spark, d)


# --------------------------------------------------------------------------- X
def child_explode(spark, d):
    m = N.explode_array(orders_docs(spark, d), "movements", keep=[_pid()], with_pos=False).where(N.object_items())
    it = F.col("item")
    return m.select("process_id", tstr(V.raw_timestamp(it, "at")).alias("movement_at"),
                    V.get(it, "id", "bigint").alias("destination_id"), V.get(it, "to").alias("destination_type"))


def child_posexplode(spark, d):
    m = N.explode_array(orders_docs(spark, d), "movements", keep=[_pid()]).where(N.object_items())
    it = F.col("item")
    return m.select("process_id", F.col("pos").cast("bigint").alias("pos"),
                    V.get(it, "id", "bigint").alias("destination_id"), V.get(it, "line", "bigint").alias("line"))


def scalar_array_explode(spark, d):
    return members(spark, d).select("group_id", "user_id")


def map_explode(spark, d):
    m = N.explode_object(orders_docs(spark, d), "initiatorFields", keep=[_pid()]).where(N.object_items())
    it = F.col("item")
    return m.select("process_id", F.col("key").alias("field_key"), V.to_str(V.at(it, "id")).alias("field_id"),
                    V.get(it, "name").alias("field_name"))


def tagged_union(spark, d):
    branches = {V.singular(t): f"recipients.{t}" for t in ("users", "areas", "subareas", "groups")}
    m = N.tagged_union(orders_docs(spark, d), branches, keep=[_pid("document_id")]).where(N.object_items())
    it = F.col("item")
    return m.select("document_id", F.col("tag").alias("entity_type"), V.to_str(V.at(it, "id")).alias("entity_id"),
                    V.get(it, "name").alias("entity_name"))


def _process_documents(spark, d):
    m = N.tagged_union(orders_docs(spark, d), {"external": "documents", "internal": "internalDocuments"},
                       keep=[F.col("_seq"), _pid()]).where(N.object_items())
    return m.select("_seq", "process_id", F.col("pos").cast("bigint").alias("pos"), F.col("tag").alias("doc_type"),
                    V.to_str(V.at("item", "id")).alias("document_id"))


def two_array_union(spark, d):
    return _process_documents(spark, d).select("process_id", "doc_type", "document_id")


def unpivot_objects(spark, d):
    m = N.unpivot_objects(orders_docs(spark, d), {"signer": "lumbreNextSigner", "participant": "lumbreNextParticipant",
                                                  "reviewer": "lumbreNextReviewer"}, keep=[_pid("document_id")])
    it = F.col("item")
    uidv = V.user_id(it)
    m = m.where(uidv.isNotNull())
    return m.select("document_id", F.col("tag").alias("workflow_type"), uidv.alias("user_id"),
                    V.get(it, "role.id").alias("role_id"), V.get(it, "role.name").alias("role_name"),
                    V.get(it, "area.id", "bigint").alias("area_id"), V.get(it, "area.name").alias("area_name"))


def broadcast_parent_scalar(spark, d):
    docs = orders_docs(spark, d)
    m = N.explode_array(docs, "documentSteps.items",
                        keep=[_pid("document_id"),
                              V.default_if_missing("doc", "documentSteps.position", "bigint", 0).alias("position")])
    it = F.col("item")
    return m.where(N.object_items()).select(
        "document_id", F.col("pos").cast("bigint").alias("step_order"), "position",
        V.get(it, "title").alias("title"), V.get(it, "description").alias("description"))


def renamed_explode(spark, d):
    m = N.explode_array(orders_docs(spark, d), "recipients.emails", keep=[_pid("document_id")], with_pos=False)
    it = F.col("item")
    return m.where(N.truthy_field("name")).select("document_id", V.to_str(V.at(it, "id")).alias("email_id"),
                                                  V.get(it, "name").alias("email"))


def _recipient_users(spark, d):
    m = N.explode_array(orders_docs(spark, d), "recipients.users", keep=[F.col("_seq"), _pid()],
                        item_type="struct<id:variant,name:string>")
    # a step each, the last behind a fence: otherwise the id is read again for every use of its text
    texts = m.select("_seq", F.col("pos").cast("bigint").alias("pos"), "process_id", "item",
                     V.get("item.id", None).alias("_text"))
    named = texts.select("_seq", "pos", "process_id", V.truthy_str_at("item.id", None, F.col("_text")).alias("id"),
                         F.col("item.name").alias("name"), F.spark_partition_id().alias(FENCE))
    return named.where(F.col("id").isNotNull() & (F.col(FENCE) >= 0)).drop(FENCE)


def catalog_and_relation(spark, d):
    ex = _recipient_users(spark, d)
    catalog = U.dedupe(ex.select("id", "name", "_seq", "pos"), "id", keep="first", seq=["_seq", "pos"])
    relation = U.dedupe(ex.select("process_id", "id", "_seq", "pos"), ["process_id", "id"], keep="first",
                        seq=["_seq", "pos"])
    return (catalog.select(F.lit("catalog").alias("row_kind"), "id", "name", F.lit(None).cast("string").alias("process_id"))
            .unionByName(relation.select(F.lit("relation").alias("row_kind"), "id",
                                         F.lit(None).cast("string").alias("name"), "process_id")))


def _roles(spark, d):
    u = users_docs(spark, d)
    return u.where(V.is_object(V.at("doc", "role")) & V.truthy(V.at("doc", "role.id"))).select(
        "_seq", V.get("doc", "role.id").alias("id"), V.get("doc", "role.name").alias("name"))


def catalog_rows(spark, d):
    return U.dedupe(_roles(spark, d), "id", keep="last").select("id", "name")


def dynamic_fields_fixed(spark, d):
    docs = orders_docs(spark, d)
    dyn = N.dynamic_fields_fixed("doc", ["_3", "_4", "_5", "_6", "_7"])
    ex = docs.select(_pid(), dyn.alias("dyn")).select("process_id", F.explode(V.as_object(F.col("dyn"))).alias("k", "v"))
    return ex.select("process_id", F.col("k").alias("field_key"), V.json_text(F.col("v")).alias("field_value"))


def dynamic_fields_regex(spark, d):
    docs = orders_docs(spark, d)
    ex = docs.select(_pid(), N.dynamic_fields_regex("doc").alias("dyn")).select(
        "process_id", F.explode(V.as_object(F.col("dyn"))).alias("k", "v"))
    return ex.select("process_id", F.col("k").alias("field_key"), V.json_text(F.col("v")).alias("field_value"))


# --------------------------------------------------------------------------- J / R
def semi_filter(spark, d):
    return R.keep_if_parent(members(spark, d), "user_id", users_main_ids(spark, d), "id").select("group_id", "user_id")


def null_out_fk(spark, d):
    return R.null_if_orphan(members(spark, d).select("group_id", "pos", "user_id"), "user_id",
                            users_main_ids(spark, d), "id")


def orphans(spark, d):
    return R.orphans(members(spark, d), "user_id", users_main_ids(spark, d), "id").select("group_id", "user_id")


def _ghosts(spark, d, flavour):
    g = R.ghost_users(orders_docs(spark, d), users_main_ids(spark, d), flavour=flavour, run_ts=run_ts())
    return g.select("id", "firstname", "lastname", "email", "username", "deleted")


def ghosts_standard(spark, d):
    return _ghosts(spark, d, "standard")


def ghosts_groups(spark, d):
    return _ghosts(spark, d, "groups")


def ghosts_processtypes(spark, d):
    return _ghosts(spark, d, "processtypes")


def members_with_ghosts(spark, d):
    users = users_main_ids(spark, d)
    ghosts = R.ghost_users(orders_docs(spark, d), users, flavour="standard", run_ts=run_ts())
    valid = R.valid_parents(users, ghosts)
    return R.keep_if_parent(members(spark, d), "user_id", valid, "id").select("group_id", "user_id")


def dependency_check(spark, d):
    return R.dependency_check({"orders": orders_docs(spark, d), "users": users_docs(spark, d)})


# --------------------------------------------------------------------------- U
def _part_users_catalog(spark, d):
    """Existing target: user catalog named in recipients (first seen wins)."""
    ex = _recipient_users(spark, d)
    return U.dedupe(ex.select("id", "name", "_seq", "pos"), "id", keep="first", seq=["_seq", "pos"]).select("id", "name")


def _incoming_users(spark, d):
    return users_docs(spark, d).select(V.oid("doc").alias("id"), V.get("doc", "firstname").alias("name"), "_seq")


def upsert_last(spark, d):
    return U.upsert(_part_users_catalog(spark, d), _incoming_users(spark, d), "id", policy="last")


def upsert_first(spark, d):
    return U.upsert(_part_users_catalog(spark, d), _incoming_users(spark, d), "id", policy="first")


def upsert_batched(spark, d):
    return U.dedupe(_roles(spark, d), "id", batch_size=BATCH).select("id", "name")


def _movement_rows(spark, d):
    m = N.explode_array(orders_docs(spark, d), "movements", keep=[F.col("_seq"), _pid()])
    return m.select("_seq", "process_id", F.col("pos").cast("bigint").alias("pos"),
                    V.get("item", "line", "bigint").alias("line"))


def strict_insert_rejects(spark, d):
    rows = _movement_rows(spark, d).where(F.col("line").isNotNull())
    _, rejects = U.strict_insert(rows, ["process_id", "line"], order=["_seq", "pos"])
    return rejects.select("process_id", "line", "pos", "reject_reason")


def null_key_bypass(spark, d):
    rows = _movement_rows(spark, d)
    return U.dedupe(rows, ["process_id", "line"], keep="first", seq=["_seq", "pos"]).select("process_id", "line", "pos")


def sync_members(spark, d):
    docs = orders_docs(spark, d)
    target = N.tagged_union(docs, {"area": "recipients.areas"}, keep=[_pid("group_id")]).select(
        "group_id", V.to_str(V.at("item", "id")).alias("user_id"))
    incoming = members(spark, d).select("group_id", "user_id")
    present = docs.select(_pid("group_id"))
    return U.sync_members(target, incoming, "group_id", present)


def full_refresh(spark, d):
    """Users.main refreshed from its collection: rows of the previous state are gone."""
    old = _part_users_catalog(spark, d)
    return U.full_refresh(old, _incoming_users(spark, d))


QUERIES = {
    "main_projection": main_projection,
    "timestamp_formats": timestamp_formats,
    "truthy_defaults": truthy_defaults,
    "json_forms": json_forms,
    "full_name": full_name,
    "optional_one_to_one": optional_one_to_one,
    "child_explode": child_explode,
    "child_posexplode": child_posexplode,
    "scalar_array_explode": scalar_array_explode,
    "map_explode": map_explode,
    "tagged_union": tagged_union,
    "two_array_union": two_array_union,
    "unpivot_objects": unpivot_objects,
    "broadcast_parent_scalar": broadcast_parent_scalar,
    "renamed_explode": renamed_explode,
    "catalog_and_relation": catalog_and_relation,
    "catalog_rows": catalog_rows,
    "dynamic_fields_fixed": dynamic_fields_fixed,
    "dynamic_fields_regex": dynamic_fields_regex,
    "semi_filter": semi_filter,
    "null_out_fk": null_out_fk,
    "orphans": orphans,
    "ghosts_standard": ghosts_standard,
    "ghosts_groups": ghosts_groups,
    "ghosts_processtypes": ghosts_processtypes,
    "members_with_ghosts": members_with_ghosts,
    "dependency_check": dependency_check,
    "upsert_last": upsert_last,
    "upsert_first": upsert_first,
    "upsert_batched": upsert_batched,
    "strict_insert_rejects": strict_insert_rejects,
    "null_key_bypass": null_key_bypass,
    "sync_members": sync_members,
    "full_refresh": full_refresh,
}

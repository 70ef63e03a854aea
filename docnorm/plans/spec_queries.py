"""Driver queries that run whole collection specs (the normaliser with ghosts, parent
rules and key policies) on the nested order collection, with SQL oracles."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import collections as CL
from .oracle import F_TS, LI, OD, USERS, _uid, _w
from .queries import orders_docs, run_ts, tstr, users_main_ids
from .spec import normalise


def _processes(spark, d, columns=None):
    return normalise(CL.PROCESSES, orders_docs(spark, d), users=users_main_ids(spark, d), run_ts=run_ts(), columns=columns)


def spec_processes_main(spark, d):
    m = _processes(spark, d).tables["main"]
    return m.select(*[tstr(F.col(c)).alias(c) if t == "timestamp_ntz" else F.col(c)
                      for c, t in CL.PROCESSES.main.schema()])


def spec_process_documents(spark, d):
    return _processes(spark, d).tables["process_documents"]


def spec_group_members(spark, d):
    r = normalise(CL.USERSGROUPS, orders_docs(spark, d), users=users_main_ids(spark, d), run_ts=run_ts())
    return r.tables["members"]


def spec_users_main(spark, d):
    from .queries import users_docs
    m = normalise(CL.USERS, users_docs(spark, d), run_ts=run_ts()).tables["main"]
    return m.select(*[tstr(F.col(c)).alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in CL.USERS.main.schema()])


def _processtypes(spark, d):
    from .queries import users_docs
    from ..sources import nest
    users = normalise(CL.USERS, users_docs(spark, d), run_ts=run_ts()).tables
    parents = {f"lml_users.{t}": users[t] for t in ("areas", "subareas", "roles")}
    return normalise(CL.PROCESSTYPES, nest.docs(spark, d, "processtypes"), users=users["main"].select("id"),
                     parents=parents, run_ts=run_ts())


def spec_type_prefixes(spark, d):
    return _processtypes(spark, d).tables["type_prefixes"]


def spec_people_types(spark, d):
    return _processtypes(spark, d).tables["people_types"]


def spec_starter_people_types(spark, d):
    return _processtypes(spark, d).tables["starter_people_types"]


def spec_instance_actions_area(spark, d):
    return _processtypes(spark, d).tables["instance_actions_area"]


def spec_process_fields(spark, d):
    return _processtypes(spark, d).tables["process_fields"].select("processtype_id", "field_id", "field_order", "class")


def _people(spark, d):
    from ..sources import nest
    return normalise(CL.PEOPLE, nest.docs(spark, d, "people"), run_ts=run_ts())


def spec_people_main(spark, d):
    m = _people(spark, d).tables["main"]
    return m.select("people_id", "people_type_id", "person_id_type_id", "person_name", "person_email",
                    "domicilio_humana", F.to_json("dynamic_fields").alias("dynamic_fields"),
                    tstr(F.col("created_at")).alias("created_at"), tstr(F.col("updated_at")).alias("updated_at"),
                    "deleted", "lumbre_version", "created_by_user_id")


def spec_people_types_catalog(spark, d):
    return _people(spark, d).tables["people_types"]


def spec_person_id_types(spark, d):
    return _people(spark, d).tables["person_id_types"]


def _listbuilder(spark, d):
    from ..sources import nest
    return normalise(CL.LISTBUILDER, nest.docs(spark, d, "listbuilder"), run_ts=run_ts())


def spec_listbuilder_main(spark, d):
    m = _listbuilder(spark, d).tables["main"]
    return m.select("listbuilder_id", "alias", "title_list", F.to_json("gql_variables").alias("gql_variables"),
                    "mode_table", "mode_map", "lumbre_internal", "mongo_version", "created_by_user_id")


def spec_listbuilder_fields(spark, d):
    return _listbuilder(spark, d).tables["fields"]


def spec_search_fields_selected(spark, d):
    return _listbuilder(spark, d).tables["search_fields_selected"]


def spec_search_fields_rejects(spark, d):
    return _listbuilder(spark, d).rejects["search_fields_selected"].select(
        "listbuilder_id", "field_name", "field_order", "reject_reason")


def spec_button_links(spark, d):
    return _listbuilder(spark, d).tables["button_links"]


def spec_listbuilder_privileges(spark, d):
    return _listbuilder(spark, d).tables["privileges"]


def _documents(spark, d, *only):
    return normalise(CL.DOCUMENTS, orders_docs(spark, d), users=users_main_ids(spark, d), run_ts=run_ts(), only=only or None)


def spec_documents_recipients(spark, d):
    return _documents(spark, d, "recipients").tables["recipients"]


def spec_documents_steps(spark, d):
    return _documents(spark, d, "steps").tables["steps"]


def spec_next_workflow(spark, d):
    return _documents(spark, d, "next_workflow").tables["next_workflow"].select(
        "document_id", "workflow_type", "user_id", "role_id", "role_name", "area_id", "area_name", "firstname")


def _formbuilder(spark, d):
    from ..sources import nest
    return normalise(CL.FORMBUILDER, nest.docs(spark, d, "formbuilder"), run_ts=run_ts())


def spec_form_elements(spark, d):
    e = _formbuilder(spark, d).tables["elements"]
    return e.select("formbuilder_id", e["element_id"].cast("double").alias("element_id"), "component_name", "class_name",
                    F.to_json("component_props").alias("component_props"), "is_hidden_on_pdf", "has_label_on_pdf",
                    "order_index")


def spec_form_allow_create(spark, d):
    r = _formbuilder(spark, d)
    acc = r.tables["allow_create"].withColumn("reject_reason", F.lit(None).cast("string"))
    return acc.unionByName(r.rejects["allow_create"].select(*acc.columns))


def spec_form_main(spark, d):
    m = _formbuilder(spark, d).tables["main"]
    return m.select("formbuilder_id", "alias", "page_title_data", F.to_json("validations").alias("validations"),
                    tstr(F.col("created")).alias("created"), "mongo_version", "created_by_user_id")


def _docs2(spark, d, *only, columns=None):
    from ..sources import nest
    return normalise(CL.DOCUMENTS, nest.docs(spark, d, "documents"), users=users_main_ids(spark, d),
                     run_ts=run_ts(), only=only or None, columns=columns)


DOC_MAIN = ("document_id", "document_number", "document_type_id", "lumbre_total_signers", "lumbre_total_reviewers",
            "deleted", "everyone_can_access", "signer_reviewer_id", "signer_reviewer_done", "signer_position_map",
            "dynamic_fields", "created_by_user_id")


def spec_doc_main(spark, d):
    m = _docs2(spark, d, "main", columns={"main": DOC_MAIN}).tables["main"]
    return m.select(*[F.to_json(c).alias(c) if c in ("signer_position_map", "dynamic_fields") else c for c in DOC_MAIN])


def _doc_table(name):
    def q(spark, d):
        return _docs2(spark, d, name).tables[name]
    q.__name__ = f"spec_doc_{name}"
    return q


def spec_doc_movements(spark, d):
    m = _docs2(spark, d, "movements").tables["movements"]
    return m.select("document_id", tstr(F.col("created_at")).alias("created_at"), "created_by_user_id",
                    "created_by_user_name", F.to_json("movement_data").alias("movement_data"),
                    F.to_json("documentation").alias("documentation"))


def spec_listbuilder_items(spark, d):
    r = _listbuilder(spark, d)
    acc = r.tables["items"].withColumn("reject_reason", F.lit(None).cast("string"))
    return acc.unionByName(r.rejects["items"].select(*acc.columns))


def spec_available_fields(spark, d):
    return _listbuilder(spark, d).tables["available_fields"]


def spec_path_actions(spark, d):
    return _listbuilder(spark, d).tables["path_actions"]


def spec_search_fields_to_selected(spark, d):
    return _listbuilder(spark, d).tables["search_fields_to_selected"]


def spec_edit_area(spark, d):
    return _processtypes(spark, d).tables["instance_actions_edit_area"]


def spec_edit_role(spark, d):
    return _processtypes(spark, d).tables["instance_actions_edit_role"]


def spec_starter_initiator_types(spark, d):
    return _processtypes(spark, d).tables["starter_initiator_types"]


QUERIES = {
    "spec_listbuilder_items": spec_listbuilder_items,
    "spec_available_fields": spec_available_fields,
    "spec_path_actions": spec_path_actions,
    "spec_search_fields_to_selected": spec_search_fields_to_selected,
    "spec_edit_area": spec_edit_area,
    "spec_edit_role": spec_edit_role,
    "spec_starter_initiator_types": spec_starter_initiator_types,
    "spec_doc_main": spec_doc_main,
    "spec_doc_participants": _doc_table("participants"),
    "spec_doc_signers": _doc_table("signers"),
    "spec_doc_share_with": _doc_table("share_with"),
    "spec_doc_viewers": _doc_table("viewers"),
    "spec_doc_instance_privileges": _doc_table("instance_privileges"),
    "spec_doc_access": _doc_table("access"),
    "spec_doc_movements": spec_doc_movements,
    "spec_form_main": spec_form_main,
    "spec_form_elements": spec_form_elements,
    "spec_form_allow_create": spec_form_allow_create,
    "spec_documents_recipients": spec_documents_recipients,
    "spec_documents_steps": spec_documents_steps,
    "spec_next_workflow": spec_next_workflow,
    "spec_people_main": spec_people_main,
    "spec_people_types_catalog": spec_people_types_catalog,
    "spec_person_id_types": spec_person_id_types,
    "spec_listbuilder_main": spec_listbuilder_main,
    "spec_listbuilder_fields": spec_listbuilder_fields,
    "spec_search_fields_selected": spec_search_fields_selected,
    "spec_search_fields_rejects": spec_search_fields_rejects,
    "spec_button_links": spec_button_links,
    "spec_listbuilder_privileges": spec_listbuilder_privileges,
    "spec_type_prefixes": spec_type_prefixes,
    "spec_people_types": spec_people_types,
    "spec_starter_people_types": spec_starter_people_types,
    "spec_instance_actions_area": spec_instance_actions_area,
    "spec_process_fields": spec_process_fields,
    "spec_users_main": spec_users_main,
    "spec_processes_main": spec_processes_main,
    "spec_process_documents": spec_process_documents,
    "spec_group_members": spec_group_members,
}

_CE = "CASE k % 6 WHEN 0 THEN T WHEN 1 THEN date_trunc('second', T) WHEN 2 THEN T WHEN 3 THEN T END"

_DAY = "make_timestamp(2020, ck % 12 + 1, ck % 28 + 1, ck % 24, ck % 60, 0)"

_PT = "printf('T%08d', CAST(p_partkey AS BIGINT))"
_SEG = "(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[p_partkey % 5 + 1]"

_SID = "printf('S%08d', CAST(s_suppkey AS BIGINT))"
_LID = "printf('L%08d', CAST(event_id AS BIGINT))"
_SDAY = "make_timestamp(2021, s_suppkey % 12 + 1, s_suppkey % 28 + 1, s_suppkey % 24, 0, 0)"

_FID = "printf('F%08d', CAST(c_custkey AS BIGINT))"
_DID = ("('D' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || "
        "CAST(l_quantity AS BIGINT))")
_UP, _US = _uid("l_partkey"), _uid("l_suppkey")

ORACLE = {
    "spec_listbuilder_items": f"""SELECT listbuilder_id, item_name, item_order,
 CASE WHEN rn > 1 THEN 'duplicate_key' END AS reject_reason FROM (
 SELECT listbuilder_id, item_name, item_order,
        row_number() OVER (PARTITION BY listbuilder_id, item_name ORDER BY item_order) AS rn FROM (
   SELECT {_LID} AS listbuilder_id, 'i1' AS item_name, 0 AS item_order FROM events
   UNION ALL SELECT {_LID}, 'i1', 2 FROM events
   UNION ALL SELECT {_LID}, 'i' || (event_id % 3), 3 FROM events))""",

    "spec_available_fields": f"""SELECT {_LID} AS listbuilder_id, event_type AS field_key, 'T' AS field_label,
 FALSE AS sortable, 0 AS field_order FROM events""",

    "spec_path_actions": f"""SELECT {_LID} AS listbuilder_id, '/a' AS action_to, 't' AS tooltip,
 'fa' AS font_awesome_icon, 0 AS action_order FROM events WHERE event_id % 2 = 1""",

    "spec_search_fields_to_selected": f"""SELECT {_LID} AS listbuilder_id, event_type AS field_name, 0 AS field_order
FROM events""",

    "spec_edit_area": f"""SELECT {_PT} AS processtype_id, CAST((p_size + 1) % 25 AS VARCHAR) AS area_id, 'EA' AS area_name
FROM part WHERE CAST((p_size + 1) % 25 AS VARCHAR) IN
  (SELECT CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey <> 0)""",

    "spec_edit_role": f"""SELECT {_PT} AS processtype_id, {_SEG} AS role_id, 'ER' AS role_name FROM part
WHERE p_partkey % 6 <> 0 AND {_SEG} IN (SELECT c_mktsegment FROM customer WHERE c_custkey % 7 >= 3)""",

    "spec_starter_initiator_types": f"""SELECT {_PT} AS processtype_id, 'I' || (p_partkey % 4) AS initiator_type_id
FROM part""",

    "spec_doc_main": f"""SELECT {_DID} AS document_id, CAST(l_orderkey AS VARCHAR) AS document_number,
 l_returnflag AS document_type_id, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber ELSE 0 END AS INTEGER)
   AS lumbre_total_signers, CAST(NULL AS INTEGER) AS lumbre_total_reviewers, l_linestatus = 'F' AS deleted,
 l_linenumber % 3 <> 0 AS everyone_can_access,
 CASE WHEN l_linenumber % 2 = 1 THEN {_US} END AS signer_reviewer_id,
 CASE WHEN l_linenumber % 2 = 1 THEN TRUE END AS signer_reviewer_done,
 CASE WHEN l_linenumber % 4 = 0 THEN '{{}}' END AS signer_position_map,
 '{{"campo_' || (l_linenumber % 3) || '":"x"}}' AS dynamic_fields, {_US} AS created_by_user_id
FROM lineitem""",

    "spec_doc_participants": f"""SELECT {_DID} AS document_id, {_UP} AS user_id, 'P' || l_partkey AS user_name,
 'sign' AS action FROM lineitem
UNION ALL SELECT {_DID}, {_US}, 'S' || l_suppkey, 'view' FROM lineitem""",

    "spec_doc_signers": f"""SELECT {_DID} AS document_id, {_UP} AS user_id, 'P' || l_partkey AS user_name,
 CAST(NULL AS VARCHAR) AS action FROM lineitem""",

    "spec_doc_share_with": f"""SELECT {_DID} AS document_id, {_US} AS user_id, 'S' || l_suppkey AS user_name
FROM lineitem""",

    "spec_doc_viewers": f"""SELECT {_DID} AS document_id, 'user' AS entity_type, {_UP} AS entity_id,
 'P' || l_partkey AS entity_name FROM lineitem
UNION ALL SELECT {_DID}, 'area', CAST(l_suppkey % 25 AS VARCHAR), 'A' || (l_suppkey % 25) FROM lineitem
WHERE l_suppkey % 25 <> 0""",

    "spec_doc_instance_privileges": f"""SELECT {_DID} AS document_id, 'area' AS entity_type,
 CAST(l_partkey % 25 AS VARCHAR) AS entity_id, 'A' || (l_partkey % 25) AS entity_name FROM lineitem
WHERE l_partkey % 25 <> 0
UNION ALL SELECT {_DID}, 'role', l_returnflag, 'R' || l_returnflag FROM lineitem""",

    "spec_doc_access": f"""SELECT DISTINCT document_id, entity_type, entity_id FROM (
 SELECT {_DID} AS document_id, 'user' AS entity_type, {_UP} AS entity_id FROM lineitem
 UNION ALL SELECT {_DID}, 'user', {_US} FROM lineitem
 UNION ALL SELECT {_DID}, 'area', CAST(l_suppkey % 25 AS VARCHAR) FROM lineitem WHERE l_suppkey % 25 <> 0)""",

    "spec_doc_movements": f"""SELECT {_DID} AS document_id, strftime(l_shipdate, {F_TS}) AS created_at,
 CASE WHEN l_linenumber NOT IN (5, 6) THEN {_US} END AS created_by_user_id,
 CASE WHEN l_linenumber NOT IN (5, 6)
      THEN trim('F' || l_suppkey || ' ' || CASE WHEN l_linenumber % 2 = 0 THEN 'L' ELSE '' END) END AS created_by_user_name,
 '{{"step":' || l_linenumber || '}}' AS movement_data, '[]' AS documentation FROM lineitem""",

    "spec_form_main": f"""SELECT {_FID} AS formbuilder_id, c_name AS alias, 'Form ' || c_custkey AS page_title_data,
 CASE WHEN c_custkey % 4 = 0 THEN '{{"required":true}}' END AS validations,
 '2020-01-02 03:04:05.678000' AS created, CAST(c_custkey % 4 AS INTEGER) AS mongo_version,
 {_uid('c_custkey')} AS created_by_user_id FROM customer""",

    "spec_form_elements": f"""SELECT {_FID} AS formbuilder_id, CAST(c_custkey AS DOUBLE) AS element_id,
 c_mktsegment AS component_name, 'c' AS class_name,
 CASE WHEN c_custkey % 2 = 0 THEN '{{"a":' || c_custkey || '}}' END AS component_props,
 c_custkey % 3 = 0 AS is_hidden_on_pdf, CAST(NULL AS BOOLEAN) AS has_label_on_pdf, 0 AS order_index FROM customer
UNION ALL SELECT {_FID}, c_custkey * 1.5, 'second', NULL, NULL, NULL, TRUE, 2 FROM customer""",

    "spec_form_allow_create": f"""SELECT {_FID} AS formbuilder_id, CAST(c_nationkey AS VARCHAR) AS privilege_id,
 'N' || c_nationkey AS name, 'X' AS codigo_privilegio, CAST(NULL AS VARCHAR) AS reject_reason FROM customer
UNION ALL SELECT {_FID}, CAST(c_nationkey AS VARCHAR), 'N' || c_nationkey, 'X', 'duplicate_key' FROM customer""",

    "spec_documents_recipients": _w(OD) + f"""SELECT DISTINCT od.pid AS document_id, 'user' AS entity_type,
 {_uid('l.l_partkey')} AS entity_id, 'P' || l.l_partkey AS entity_name FROM lineitem l JOIN od ON l.l_orderkey = od.k
UNION ALL SELECT pid, 'area', CAST(c_nationkey AS VARCHAR), n_name FROM od WHERE c_nationkey <> 0
UNION ALL SELECT pid, 'subarea', CAST(n_regionkey AS VARCHAR), r_name FROM od WHERE k % 2 = 1 AND n_regionkey <> 0""",

    "spec_documents_steps": _w(OD, LI) + """SELECT od.pid AS document_id,
 CAST(CASE WHEN od.k % 4 = 3 THEN 0 ELSE od.k % 4 END AS INTEGER) AS position, CAST(li.pos AS INTEGER) AS step_order,
 'T' || li.l_linenumber AS title, li.l_returnflag AS description, CAST(NULL AS VARCHAR) AS avatar
FROM li JOIN od ON li.l_orderkey = od.k""",

    "spec_next_workflow": _w(OD) + """SELECT pid AS document_id, 'signer' AS workflow_type, U AS user_id,
 c_mktsegment AS role_id, c_name AS role_name, CAST(c_nationkey AS VARCHAR) AS area_id, n_name AS area_name,
 CAST(NULL AS VARCHAR) AS firstname FROM od WHERE k % 2 = 0
UNION ALL SELECT pid, 'participant', U, NULL, NULL, NULL, NULL, NULL FROM od WHERE k % 3 = 0""",

    "spec_people_main": f"""SELECT {_SID} AS people_id,
 CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'PT' || (s_nationkey % 4) END AS people_type_id,
 CASE WHEN s_suppkey % 7 <> 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'DNI' ELSE 'CUIT' END END AS person_id_type_id,
 s_name AS person_name, CASE WHEN s_suppkey % 3 <> 0 THEN 's' || s_suppkey || '@x.org' END AS person_email,
 CASE WHEN s_suppkey % 2 = 0 THEN 'Street ' || s_suppkey END AS domicilio_humana,
 '{{"_4":"v' || s_suppkey || '"' || CASE WHEN s_suppkey % 3 = 0 THEN ',"_6":{{"a":' || s_suppkey || '}}' ELSE '' END
   || '}}' AS dynamic_fields,
 strftime(CASE WHEN s_suppkey % 2 = 0 THEN {_SDAY} ELSE TIMESTAMP '2030-01-01 00:00:00' END, {F_TS}) AS created_at,
 strftime(CASE WHEN s_suppkey % 4 = 0 THEN {_SDAY} + INTERVAL 1 HOUR
               WHEN s_suppkey % 2 = 0 THEN {_SDAY} ELSE TIMESTAMP '2030-01-01 00:00:00' END, {F_TS}) AS updated_at,
 s_suppkey % 6 = 0 AS deleted, CAST(s_suppkey % 3 AS INTEGER) AS lumbre_version,
 printf('su%05d', CAST(s_suppkey AS BIGINT)) AS created_by_user_id
FROM supplier""",

    "spec_people_types_catalog": """SELECT id, name, alias FROM (
 SELECT 'PT' || (s_nationkey % 4) AS id, 'Type' || (s_nationkey % 4) || '-' || (s_suppkey % 3) AS name,
        'alias' || (s_nationkey % 4) AS alias, row_number() OVER (PARTITION BY s_nationkey % 4 ORDER BY s_suppkey DESC) AS rn
 FROM supplier WHERE s_suppkey % 5 <> 0) WHERE rn = 1""",

    "spec_person_id_types": """SELECT id, name FROM (
 SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'DNI' ELSE 'CUIT' END AS id,
        'Doc' || (s_suppkey % 2) || '-' || (s_suppkey % 3) AS name,
        row_number() OVER (PARTITION BY s_suppkey % 2 ORDER BY s_suppkey DESC) AS rn
 FROM supplier WHERE s_suppkey % 7 <> 0) WHERE rn = 1""",

    "spec_listbuilder_main": f"""SELECT {_LID} AS listbuilder_id, event_type AS alias, 'List ' || event_id AS title_list,
 CASE WHEN event_id % 5 <> 0 THEN replace(props, ' ', '') END AS gql_variables,
 event_id % 3 <> 0 AS mode_table, event_id % 3 = 0 AS mode_map, event_id % 4 = 0 AS lumbre_internal,
 CAST(event_id % 2 AS INTEGER) AS mongo_version, {_uid('user_id')} AS created_by_user_id
FROM events""",

    "spec_listbuilder_fields": f"""SELECT {_LID} AS listbuilder_id, 'f1' AS field_key, 'L1' AS field_label, TRUE AS sortable,
 0 AS field_order FROM events
UNION ALL SELECT {_LID}, 'f2', 'L2', FALSE, 2 FROM events
UNION ALL SELECT {_LID}, 'f1', 'dup', FALSE, 3 FROM events WHERE event_id % 2 = 0""",

    "spec_search_fields_selected": f"""SELECT {_LID} AS listbuilder_id, 'a' AS field_name, 0 AS field_order FROM events
UNION ALL SELECT {_LID}, 'b', 2 FROM events""",

    "spec_search_fields_rejects": f"""SELECT {_LID} AS listbuilder_id, 'a' AS field_name, 3 AS field_order,
 'duplicate_key' AS reject_reason FROM events""",

    "spec_button_links": f"""SELECT {_LID} AS listbuilder_id, 'go' AS button_value, '/x' AS button_to,
 CAST(NULL AS VARCHAR) AS button_class, CAST(NULL AS VARCHAR) AS endpoint_to_validate_visibility,
 FALSE AS show_button, FALSE AS disabled, 0 AS button_order FROM events
UNION ALL SELECT {_LID}, 'back', NULL, NULL, NULL, TRUE, FALSE, 1 FROM events""",

    "spec_listbuilder_privileges": f"""SELECT {_LID} AS listbuilder_id, CAST(user_id AS VARCHAR) AS privilege_id,
 'priv' || user_id AS privilege_name, 'C' || user_id AS privilege_code FROM events""",

    "spec_type_prefixes": """SELECT id, name FROM (
 SELECT p_brand AS id, p_brand || '-' || (p_partkey % 3) AS name,
        row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey // 2000, p_partkey DESC) AS rn
 FROM part WHERE p_size % 3 <> 0) WHERE rn = 1""",

    "spec_people_types": """SELECT id, name FROM (
 SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY k // 2000, k DESC, pos DESC) AS rn FROM (
   SELECT p_partkey AS k, 0 AS pos, 'P' || (p_size % 5) AS id, 'People' || (p_size % 5) AS name FROM part
   UNION ALL SELECT p_partkey, 1, 'P' || (p_size % 7), CASE WHEN p_size % 7 = 6 THEN '' ELSE 'People7-' || (p_size % 7) END
   FROM part)) WHERE rn = 1""",

    "spec_starter_people_types": f"""SELECT DISTINCT {_PT} AS processtype_id, id AS people_type_id FROM (
 SELECT p_partkey, 'P' || (p_size % 5) AS id FROM part UNION ALL SELECT p_partkey, 'P' || (p_size % 7) FROM part)""",

    "spec_instance_actions_area": f"""SELECT {_PT} AS processtype_id, CAST(p_size % 25 AS VARCHAR) AS area_id,
 'A' || (p_size % 25) AS area_name,
 CASE WHEN p_partkey % 6 <> 0 AND {_SEG} IN (SELECT c_mktsegment FROM customer WHERE c_custkey % 7 >= 3) THEN {_SEG} END
   AS role_id, 'R' AS action
FROM part WHERE CAST(p_size % 25 AS VARCHAR) IN (SELECT CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey <> 0)""",

    "spec_process_fields": f"""SELECT {_PT} AS processtype_id, CAST(p_partkey * 10 AS VARCHAR) AS field_id, 0 AS field_order,
 'c' AS class FROM part
UNION ALL SELECT {_PT}, NULL, 1, 'noid' FROM part
UNION ALL SELECT {_PT}, NULL, 2, NULL FROM part
UNION ALL SELECT {_PT}, 'dup', 3, 'first' FROM part""",

    "spec_users_main": f"""WITH u AS (SELECT c_custkey AS ck, * FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT {_uid('ck')} AS id, 'F' || ck AS firstname, c_mktsegment AS lastname,
 CASE WHEN ck % 4 <> 0 THEN c_name END AS username, 'c' || ck || '@x.org' AS email, CAST(NULL AS VARCHAR) AS password,
 CASE WHEN ck % 7 = 2 THEN '' WHEN ck % 7 >= 3 THEN c_mktsegment END AS role_id,
 CAST(c_nationkey AS VARCHAR) AS area_id, CAST(n_regionkey AS VARCHAR) AS subarea_id,
 CAST(NULL AS VARCHAR) AS position_id, CAST(NULL AS VARCHAR) AS signaturetype_id,
 CAST(CASE WHEN ck % 3 = 1 THEN c_nationkey + 100 ELSE c_nationkey END AS VARCHAR) AS customer_id,
 CASE ck % 3 WHEN 0 THEN FALSE WHEN 2 THEN TRUE END AS deleted,
 CAST(NULL AS VARCHAR) AS user_type, CAST(NULL AS VARCHAR) AS license_status, CAST(NULL AS VARCHAR) AS signature,
 CAST(NULL AS VARCHAR) AS dni, CAST(ck % 5 AS INTEGER) AS lumbre_version,
 strftime(CASE WHEN ck % 2 = 0 OR ck % 4 = 1 THEN {_DAY} END, {F_TS}) AS created_at,
 CAST(NULL AS VARCHAR) AS updated_at, {_uid('ck + 1')} AS updated_by_user_id, CAST(ck % 10 AS INTEGER) AS __v
FROM u""",

    "spec_processes_main": _w(OD) + f"""SELECT pid AS process_id, CAST(k AS VARCHAR) AS process_number,
 o_orderpriority AS process_type_name, CAST(NULL AS VARCHAR) AS process_address,
 'pt' || CAST(k % 7 AS VARCHAR) AS process_type_id, CAST(ck AS VARCHAR) AS customer_id,
 CASE WHEN o_orderstatus = 'F' THEN TRUE END AS deleted,
 strftime({_CE}, {F_TS}) AS created_at, strftime(T + INTERVAL 1 DAY, {F_TS}) AS updated_at,
 strftime(o_orderdate, {F_TS}) AS process_date, o_orderstatus AS lumbre_status_name,
 CASE WHEN k % 5 <> 0 THEN CAST(ck AS VARCHAR) END AS starter_id,
 CASE WHEN k % 5 <> 0 THEN c_name END AS starter_name,
 CASE WHEN k % 5 <> 0 THEN c_mktsegment END AS starter_type,
 CASE WHEN ck % 5 IN (0, 1, 2) THEN U END AS created_by_user_id,
 CASE WHEN k % 4 IN (1, 3) THEN {_uid('k // 4')} END AS updated_by_user_id
FROM od""",

    "spec_process_documents": _w(OD, LI) + """, u AS (
  SELECT od.pid AS process_id, 'external' AS doc_type, 'p' || li.l_partkey AS document_id, 0 AS b, li.pos
  FROM li JOIN od ON li.l_orderkey = od.k
  UNION ALL SELECT od.pid, 'internal', 's' || li.l_suppkey, 1, li.pos
  FROM li JOIN od ON li.l_orderkey = od.k WHERE od.k % 2 = 0)
SELECT process_id, doc_type, document_id FROM (
  SELECT *, row_number() OVER (PARTITION BY process_id, document_id ORDER BY b, pos) AS rn FROM u) WHERE rn = 1""",

    "spec_group_members": _w(OD, LI) + f""", g AS (SELECT DISTINCT {_uid('k // 4')} AS id FROM od WHERE k % 2 = 1),
valid AS (SELECT id FROM {USERS} UNION SELECT id FROM g),
m AS (SELECT od.pid AS group_id, {_uid('li.l_partkey')} AS user_id, li.pos FROM li JOIN od ON li.l_orderkey = od.k)
SELECT group_id, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id, user_id ORDER BY pos) AS rn FROM m
  WHERE user_id IN (SELECT id FROM valid)) WHERE rn = 1""",
}

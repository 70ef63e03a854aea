"""Driver queries for the target tables that the other query modules leave out, each the
whole table (all columns, policies, parent rules, ghosts on) from its collection spec."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import validate as VAL
from ..sources import nest
from . import collections as CL
from .oracle import F_TS, LJ, OD, ORACLE as _OPERATOR_ORACLE, _uid, _w
from .queries import orders_docs, run_ts, tstr, users_docs, users_main_ids
from .spec import normalise
from .spec_queries import ORACLE as _SPEC_ORACLE
from .spec_queries import _CE, _DID, _FID, _PT, _docs2, _processes, _processtypes


def _plain(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Timestamps and JSON as text."""
    kinds = {"timestamp_ntz": lambda n: tstr(F.col(n)), "variant": lambda n: F.to_json(n)}
    return df.select(*[kinds.get(t, F.col)(n).alias(n) for n, t in schema])


def _users(collection):
    return lambda spark, d, columns=None: normalise(CL.USERS, collection(spark, d), run_ts=run_ts(), columns=columns)


def _groups(spark, d, columns=None):
    return normalise(CL.USERSGROUPS, orders_docs(spark, d), users=users_main_ids(spark, d), run_ts=run_ts(), columns=columns)


def _forms(spark, d):
    return normalise(CL.FORMBUILDER, nest.docs(spark, d, "formbuilder"), users=users_main_ids(spark, d), run_ts=run_ts())


def _order_documents(spark, d):
    return normalise(CL.DOCUMENTS, orders_docs(spark, d), users=users_main_ids(spark, d), run_ts=run_ts())


_customers = _users(users_docs)
_staff = _users(lambda spark, d: nest.docs(spark, d, "staff"))


def _table(build, collection, name):
    def query(spark, d):
        return _plain(build(spark, d).tables[name], collection.table(name).schema())
    return query


def fk_graph(spark, d):
    """V7: every foreign key among users, groups and processes as normalised, ghost users not added."""
    tables, keys = {}, CL.foreign_keys()
    for build, collection in ((_customers, CL.USERS), (_groups, CL.USERSGROUPS), (_processes, CL.PROCESSES)):
        names = {t.name: f"{collection.name}.{t.name}" for t in collection.tables}
        done = build(spark, d, columns={t: VAL.key_columns(name, keys) for t, name in names.items()}).tables
        tables |= {name: done[t] for t, name in names.items()}
    return VAL.fk_graph_violations(tables, keys)


QUERIES = {
    "fk_graph": fk_graph,
    "table_users_roles": _table(_customers, CL.USERS, "roles"),
    "table_users_areas": _table(_customers, CL.USERS, "areas"),
    "table_users_subareas": _table(_customers, CL.USERS, "subareas"),
    "table_users_positions": _table(_staff, CL.USERS, "positions"),
    "table_users_signaturetypes": _table(_staff, CL.USERS, "signaturetypes"),
    "table_usersgroups_main": _table(_groups, CL.USERSGROUPS, "main"),
    "table_processes_movements": _table(_processes, CL.PROCESSES, "movements"),
    "table_processes_initiator_fields": _table(_processes, CL.PROCESSES, "initiator_fields"),
    "table_processes_last_movements": _table(_processes, CL.PROCESSES, "last_movements"),
    "table_formbuilder_allow_access": _table(_forms, CL.FORMBUILDER, "allow_access"),
    "table_formbuilder_allow_update": _table(_forms, CL.FORMBUILDER, "allow_update"),
    "table_processtypes_main": _table(_processtypes, CL.PROCESSTYPES, "main"),
    "table_processtypes_initiator_types": _table(_processtypes, CL.PROCESSTYPES, "initiator_types"),
    "table_processtypes_actions_subarea": _table(_processtypes, CL.PROCESSTYPES, "instance_actions_subarea"),
    "table_processtypes_edit_subarea": _table(_processtypes, CL.PROCESSTYPES, "instance_actions_edit_subarea"),
    "table_documents_reviewers": _table(_docs2, CL.DOCUMENTS, "reviewers"),
    "table_documents_recipient_emails": _table(_order_documents, CL.DOCUMENTS, "recipient_emails"),
}

_NULL = "CAST(NULL AS VARCHAR)"
_NO_INT, _NO_BOOL = "CAST(NULL AS INTEGER)", "CAST(NULL AS BOOLEAN)"
_NATIONS = "customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"
_SUBAREAS = f"(SELECT CAST(n.n_regionkey AS VARCHAR) FROM {_NATIONS} WHERE n.n_regionkey <> 0)"


def _last(columns: str, order: str, source: str) -> str:
    """The last row of each id."""
    return f"""SELECT * EXCLUDE (o, rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o DESC) AS rn
FROM (SELECT {columns}, {order} AS o FROM {source})) WHERE rn = 1"""


ORACLE = {
    "table_users_roles": _last("c_mktsegment AS id, c_mktsegment || '-' || (c_custkey % 3) AS name", "c_custkey",
                               "customer WHERE c_custkey % 7 >= 3"),
    "table_users_areas": _last("CAST(c_nationkey AS VARCHAR) AS id, n_name AS name, "
                               "CASE WHEN c_custkey % 2 = 0 THEN 'd' || n_regionkey END AS descripcion", "c_custkey",
                               f"{_NATIONS} WHERE c_nationkey <> 0"),
    "table_users_subareas": _last("CAST(n_regionkey AS VARCHAR) AS id, r_name AS name", "c_custkey",
                                  f"{_NATIONS} WHERE n_regionkey <> 0"),
    "table_users_positions": _last("CAST(s_nationkey AS VARCHAR) AS id, 'Position ' || s_nationkey || '-' || (s_suppkey % 3) AS name",
                                   "s_suppkey", "supplier WHERE s_nationkey <> 0"),
    "table_users_signaturetypes": _last("'st' || (s_suppkey % 3) AS id, 'Signature ' || (s_suppkey % 3) AS name, "
                                        "CASE WHEN s_suppkey % 2 = 0 THEN 'since ' || s_suppkey END AS descripcion",
                                        "s_suppkey", "supplier WHERE s_suppkey % 4 <> 0"),

    "table_usersgroups_main": _w(OD) + f"""SELECT pid AS id, {_NULL} AS name, {_NULL} AS alias,
 CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'P' THEN NULL ELSE FALSE END AS deleted,
 CAST(ck AS VARCHAR) AS customer_id, {_NO_INT} AS lumbre_version, {_NO_BOOL} AS imported_from_external,
 strftime({_CE}, {F_TS}) AS created_at, strftime(T + INTERVAL 1 DAY, {F_TS}) AS updated_at,
 CASE WHEN ck % 5 IN (0, 1, 2) THEN U END AS created_by_user_id,
 CASE WHEN k % 4 IN (1, 3) THEN {_uid('k // 4')} END AS updated_by_user_id, CAST(k % 3 AS INTEGER) AS __v
FROM od""",

    "table_processes_movements": _w(OD) + f"""SELECT od.pid AS process_id, strftime(l.l_shipdate, {F_TS}) AS movement_at,
 CAST(l.l_partkey AS VARCHAR) AS destination_id, l.l_returnflag AS destination_type
FROM {LJ} WHERE l.l_linenumber <> 3""",
    "table_processes_initiator_fields": _OPERATOR_ORACLE["map_explode"],
    "table_processes_last_movements": _OPERATOR_ORACLE["optional_one_to_one"],

    "table_formbuilder_allow_access": f"""SELECT {_FID} AS formbuilder_id, CAST(c_nationkey AS VARCHAR) AS privilege_id,
 'N' || c_nationkey AS name, 'X' AS codigo_privilegio FROM customer""",
    "table_formbuilder_allow_update": f"""SELECT {_FID} AS formbuilder_id, CAST(c_nationkey AS VARCHAR) AS privilege_id,
 'N' || c_nationkey AS name, 'X' AS codigo_privilegio FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT {_FID}, 'own', 'O' || c_custkey, NULL FROM customer WHERE c_custkey % 2 = 0""",

    "table_processtypes_main": f"""SELECT {_PT} AS processtype_id, p_name AS type_name, p_brand AS type_alias,
 p_type AS type_numerator, p_size % 2 = 0 AS published, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS type_prefix_id,
 'pt-user-' || (p_partkey % 50) AS created_by_user_id, CAST(p_partkey % 3 AS INTEGER) AS __v, """ + ", ".join(
        [f"{_NULL} AS {c}" for c in (
            "type_description", "type_comments", "type_can_be_taken", "type_can_be_taken_detail", "tad_url", "_master",
            "listbuilder_id", "formbuilder_id", "customer_id", "type_correction_role_id", "type_reopen_role_id",
            "calculated_props", "contenttemplate_conditionals", "process_fields_validations", "suggest",
            "updated_by_user_id", "created_at", "updated_at")]
        + [f"{_NO_BOOL} AS {c}" for c in ("type_hide_comments_on_finished", "tad_available", "is_editable", "deleted",
                                          "user_who_associated_can_correct")]
        + [f"{_NO_INT} AS {c}" for c in ("lumbre_version", "_v")]) + " FROM part",
    "table_processtypes_initiator_types": """SELECT DISTINCT 'I' || (p_partkey % 4) AS id, 'Init' || (p_partkey % 4) AS name
FROM part""",
    "table_processtypes_actions_subarea": f"""SELECT {_PT} AS processtype_id, CAST(p_size % 5 AS VARCHAR) AS subarea_id,
 'S' || (p_size % 5) AS subarea_name, {_NULL} AS role_id, 'W' AS action
FROM part WHERE CAST(p_size % 5 AS VARCHAR) IN {_SUBAREAS}""",
    "table_processtypes_edit_subarea": f"""SELECT {_PT} AS processtype_id, CAST((p_size + 2) % 7 AS VARCHAR) AS subarea_id,
 'ES' AS subarea_name FROM part WHERE CAST((p_size + 2) % 7 AS VARCHAR) IN {_SUBAREAS}""",

    "table_documents_reviewers": f"""SELECT {_DID} AS document_id, {_uid('l_suppkey')} AS user_id, 'S' || l_suppkey AS user_name,
 CASE WHEN l_linenumber % 2 = 0 THEN 'review' END AS action FROM lineitem WHERE l_linenumber % 3 <> 0""",
    "table_documents_recipient_emails": _w(OD) + """SELECT pid AS document_id, CAST(ck AS VARCHAR) AS email_id,
 'c' || ck || '@x.org' AS email FROM od WHERE k % 3 = 0""",
}

# customers name no position and no signature type
_FK_TABLES = {
    "lml_users.main": _SPEC_ORACLE["spec_users_main"],
    "lml_users.roles": ORACLE["table_users_roles"],
    "lml_users.areas": ORACLE["table_users_areas"],
    "lml_users.subareas": ORACLE["table_users_subareas"],
    "lml_users.positions": f"SELECT {_NULL} AS id",
    "lml_users.signaturetypes": f"SELECT {_NULL} AS id",
    "lml_usersgroups.main": ORACLE["table_usersgroups_main"],
    "lml_usersgroups.members": _SPEC_ORACLE["spec_group_members"],
    "lml_processes.main": _SPEC_ORACLE["spec_processes_main"],
    "lml_processes.movements": ORACLE["table_processes_movements"],
    "lml_processes.initiator_fields": ORACLE["table_processes_initiator_fields"],
    "lml_processes.process_documents": _SPEC_ORACLE["spec_process_documents"],
    "lml_processes.last_movements": ORACLE["table_processes_last_movements"],
}
ORACLE["fk_graph"] = "WITH " + ", ".join(f'"{n}" AS ({sql})' for n, sql in _FK_TABLES.items()) + " UNION ALL ".join(
    f"""
SELECT '{r.child}' AS child, '{r.column}' AS "column", '{r.parent}' AS parent, count(*) AS violations FROM "{r.child}"
WHERE "{r.column}" IS NOT NULL AND "{r.column}" NOT IN (SELECT "{r.parent_column}" FROM "{r.parent}" WHERE "{r.parent_column}" IS NOT NULL)"""
    for r in CL.foreign_keys() if r.child in _FK_TABLES and r.parent in _FK_TABLES)

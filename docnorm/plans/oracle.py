"""Plain-SQL oracles (DuckDB dialect) for the driver queries, computed from the flat tables.

Each oracle derives the expected rows from the same rules the nesting builders use
(``sources/nest.py``) and the semantics of the operator under test, without any nesting.
"""
from __future__ import annotations

F_TS = "'%Y-%m-%d %H:%M:%S.%f'"


def _uid(x: str) -> str:
    return f"printf('u%06d', CAST({x} AS BIGINT))"


OD = f"""od AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderstatus, o.o_orderpriority, o.o_totalprice, o.o_orderdate,
         c.c_name, c.c_mktsegment, c.c_nationkey, c.n_name, c.n_regionkey, c.r_name,
         {_uid('o.o_custkey')} AS U,
         CASE WHEN o.o_orderkey % 3 = 2 THEN CAST(o.o_orderkey AS VARCHAR)
              ELSE lpad(hex(o.o_orderkey), 24, '0') END AS pid,
         o.o_orderdate + to_seconds(o.o_orderkey % 86400) + to_milliseconds(CAST(o.o_orderkey % 1000 AS INTEGER)) AS T
  FROM orders o
  LEFT JOIN (SELECT c.*, n.n_name, n.n_regionkey, r.r_name FROM customer c
             JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey) c
    ON o.o_custkey = c.c_custkey)"""

LI = """li AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                 l_extendedprice, l_shipdate, l_returnflag) - 1 AS pos
  FROM lineitem l)"""

LJ = "lineitem l JOIN od ON l.l_orderkey = od.k"
USERS = f"(SELECT {_uid('c_custkey')} AS id FROM customer)"


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CE = "CASE k % 6 WHEN 0 THEN T WHEN 1 THEN date_trunc('second', T) WHEN 2 THEN T WHEN 3 THEN T END"

_GHOST_BASE = _w(OD) + ", s AS (\n{created}\n UNION ALL\n{updated}),\n" + \
    "f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, slot) AS rn FROM s)\n" + \
    f"SELECT id, firstname, lastname, email, username, TRUE AS deleted FROM f WHERE rn = 1 AND id NOT IN {USERS}"

_CREATED_STD = f"""SELECT U AS id, k, 0 AS slot,
   CASE ck % 5 WHEN 0 THEN 'F' || ck WHEN 2 THEN {{n2}} END AS firstname,
   CASE ck % 5 WHEN 0 THEN c_mktsegment WHEN 2 THEN {{l2}} END AS lastname,
   CASE WHEN ck % 5 = 0 THEN 'c' || ck || '@x.org' END AS email,
   CASE WHEN ck % 5 = 0 THEN c_name END AS username
 FROM od WHERE ck % 5 IN (0, 1, 2)"""

_GID = _uid("k // 4")

ORACLE = {
    "main_projection": _w(OD) + """SELECT pid AS process_id, k AS process_number, o_orderpriority AS process_type_name,
 'pt' || CAST(k % 7 AS VARCHAR) AS process_type_id, ck AS customer_id, o_orderstatus AS lumbre_status_name,
 CASE WHEN o_orderstatus = 'F' THEN TRUE END AS deleted, o_totalprice AS total_price,
 CASE WHEN k % 5 <> 0 THEN ck END AS starter_id, CASE WHEN k % 5 <> 0 THEN c_name END AS starter_name,
 CASE WHEN k % 5 <> 0 THEN c_mktsegment END AS starter_type FROM od""",

    "timestamp_formats": _w(OD) + f"""SELECT pid AS process_id, strftime({CE}, {F_TS}) AS created_at,
 strftime(T + INTERVAL 1 DAY, {F_TS}) AS updated_at,
 strftime(coalesce({CE}, CASE WHEN k % 4 = 0 THEN o_orderdate END), {F_TS}) AS created_fallback,
 strftime(o_orderdate, {F_TS}) AS process_date,
 strftime(coalesce({CE}, TIMESTAMP '2030-01-01 00:00:00'), {F_TS}) AS created_or_run,
 strftime(coalesce(CASE WHEN k % 4 IN (0, 1) THEN o_orderdate END, {CE}, TIMESTAMP '2030-01-01 00:00:00'), {F_TS})
   AS updated_or_created
FROM od""",

    "truthy_defaults": f"""SELECT {_uid('c_custkey')} AS user_id,
 CASE c_custkey % 3 WHEN 0 THEN FALSE WHEN 2 THEN TRUE END AS deleted,
 CAST(CASE WHEN c_custkey % 3 = 1 THEN c_nationkey + 100 ELSE c_nationkey END AS BIGINT) AS customer_id,
 CAST(c_custkey % 5 AS BIGINT) AS lumbre_version,
 CASE WHEN c_custkey % 7 = 2 THEN '' WHEN c_custkey % 7 >= 3 THEN c_mktsegment END AS role_id,
 CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS username, TRUE AS mode_table, FALSE AS mode_map
FROM customer""",

    "json_forms": _w(OD) + """SELECT pid AS process_id,
 CASE k % 9 WHEN 2 THEN '{"role":{"id":"' || U || '"}}' WHEN 5 THEN '"someone"' WHEN 8 THEN '{"_id":{"$oid":""},"id":""}' END AS jt_reviewer,
 CASE WHEN k % 3 = 1 THEN '{}' WHEN k % 9 = 2 THEN '{"role":{"id":"' || U || '"}}'
   WHEN k % 9 = 8 THEN '{"_id":{"$oid":""},"id":""}' END AS jv_reviewer,
 CAST(NULL AS VARCHAR) AS jt_extra, '[]' AS jv_extra,
 CAST(NULL AS VARCHAR) AS jt_zero, CAST(NULL AS VARCHAR) AS jv_zero,
 CAST(NULL AS VARCHAR) AS jt_obj, CASE WHEN k % 5 = 0 THEN '{}' END AS jv_obj,
 CASE WHEN k % 3 = 0 THEN '[{"id":' || ck || ',"name":"c' || ck || '@x.org"}]' END AS jt_emails,
 CASE WHEN k % 3 = 0 THEN '[{"id":' || ck || ',"name":"c' || ck || '@x.org"}]' END AS jv_emails,
 CASE WHEN k % 5 <> 0 THEN '{"id":' || ck || ',"name":"' || c_name || '","starterType":"' || c_mktsegment || '"}' END
   AS jt_starter,
 CASE WHEN k % 5 <> 0 THEN '{"id":' || ck || ',"name":"' || c_name || '","starterType":"' || c_mktsegment || '"}' END
   AS jv_starter
FROM od""",

    "full_name": _w(OD) + """SELECT pid AS process_id,
 trim('F' || ck || ' ' || CASE WHEN ck % 3 = 2 THEN c_mktsegment ELSE '' END) AS origin_user_name,
 trim(c_mktsegment || ' ') AS destination_user_name
FROM od WHERE o_orderstatus <> 'O'""",

    "optional_one_to_one": _w(OD) + """SELECT pid AS process_id, U AS origin_user_id,
 trim('F' || ck || ' ' || CASE WHEN ck % 3 = 2 THEN c_mktsegment ELSE '' END) AS origin_user_name,
 'd' || k AS destination_user_id, trim(c_mktsegment || ' ') AS destination_user_name,
 n_name AS destination_area_name, r_name AS destination_subarea_name
FROM od WHERE o_orderstatus <> 'O'""",

    "child_explode": _w(OD) + f"""SELECT od.pid AS process_id, strftime(l.l_shipdate, {F_TS}) AS movement_at,
 l.l_partkey AS destination_id, l.l_returnflag AS destination_type
FROM {LJ} WHERE l.l_linenumber <> 3""",

    "child_posexplode": _w(OD, LI) + """SELECT od.pid AS process_id, li.pos AS pos, li.l_partkey AS destination_id,
 CAST(li.l_linenumber AS BIGINT) AS line
FROM li JOIN od ON li.l_orderkey = od.k WHERE li.l_linenumber <> 3""",

    "scalar_array_explode": _w(OD) + f"SELECT od.pid AS group_id, {_uid('l.l_partkey')} AS user_id FROM {LJ}",

    "map_explode": _w(OD) + """SELECT pid AS process_id, 'status' AS field_key, o_orderstatus AS field_id,
 o_orderpriority AS field_name FROM od
UNION ALL SELECT pid, 'cust', CAST(ck AS VARCHAR), c_name FROM od WHERE k % 4 <> 0""",

    "tagged_union": _w(OD) + f"""SELECT od.pid AS document_id, 'user' AS entity_type, {_uid('l.l_partkey')} AS entity_id,
 'P' || l.l_partkey AS entity_name FROM {LJ}
UNION ALL SELECT pid, 'area', CAST(c_nationkey AS VARCHAR), n_name FROM od
UNION ALL SELECT pid, 'subarea', CAST(n_regionkey AS VARCHAR), r_name FROM od WHERE k % 2 = 1""",

    "two_array_union": _w(OD) + f"""SELECT od.pid AS process_id, 'external' AS doc_type, 'p' || l.l_partkey AS document_id
FROM {LJ}
UNION ALL SELECT od.pid, 'internal', 's' || l.l_suppkey FROM {LJ} WHERE od.k % 2 = 0""",

    "unpivot_objects": _w(OD) + """SELECT pid AS document_id, 'signer' AS workflow_type, U AS user_id,
 c_mktsegment AS role_id, c_name AS role_name, CAST(c_nationkey AS BIGINT) AS area_id, n_name AS area_name
FROM od WHERE k % 2 = 0
UNION ALL SELECT pid, 'participant', U, NULL, NULL, NULL, NULL FROM od WHERE k % 3 = 0""",

    "broadcast_parent_scalar": _w(OD, LI) + """SELECT od.pid AS document_id, li.pos AS step_order,
 CAST(CASE WHEN od.k % 4 = 3 THEN 0 ELSE od.k % 4 END AS BIGINT) AS position,
 'T' || li.l_linenumber AS title, li.l_returnflag AS description
FROM li JOIN od ON li.l_orderkey = od.k""",

    "renamed_explode": _w(OD) + """SELECT pid AS document_id, CAST(ck AS VARCHAR) AS email_id,
 'c' || ck || '@x.org' AS email FROM od WHERE k % 3 = 0""",

    "catalog_and_relation": _w(OD) + f"""SELECT 'catalog' AS row_kind, {_uid('p')} AS id, 'P' || p AS name,
 CAST(NULL AS VARCHAR) AS process_id
FROM (SELECT DISTINCT l.l_partkey AS p FROM {LJ})
UNION ALL
SELECT row_kind, id, name, process_id FROM (SELECT DISTINCT 'relation' AS row_kind, {_uid('l.l_partkey')} AS id,
 CAST(NULL AS VARCHAR) AS name, od.pid AS process_id FROM {LJ})""",

    "catalog_rows": """SELECT id, arg_max(name, ck) AS name FROM (
 SELECT c_mktsegment AS id, c_mktsegment || '-' || (c_custkey % 3) AS name, c_custkey AS ck
 FROM customer WHERE c_custkey % 7 >= 3) GROUP BY id""",

    "dynamic_fields_fixed": _w(OD) + """SELECT pid AS process_id, '_' || (k % 4 + 3) AS field_key,
 CAST(ck AS VARCHAR) AS field_value FROM od WHERE k % 2 = 0 AND ck <> 0""",

    "dynamic_fields_regex": _w(OD) + """SELECT pid AS process_id, 'campo_' || (k % 3) AS field_key,
 '"' || o_orderpriority || '"' AS field_value FROM od
UNION ALL SELECT pid, '_' || (k % 4 + 3), CAST(ck AS VARCHAR) FROM od WHERE k % 2 = 0
UNION ALL SELECT pid, 'obj_8', '{}' FROM od WHERE k % 5 = 0
UNION ALL SELECT pid, 'zero_2', '0' FROM od WHERE k % 7 = 0""",

    "semi_filter": _w(OD) + f"""SELECT od.pid AS group_id, {_uid('l.l_partkey')} AS user_id FROM {LJ}
WHERE {_uid('l.l_partkey')} IN {USERS}""",

    "null_out_fk": _w(OD, LI) + f"""SELECT od.pid AS group_id, li.pos AS pos,
 CASE WHEN {_uid('li.l_partkey')} IN {USERS} THEN {_uid('li.l_partkey')} END AS user_id
FROM li JOIN od ON li.l_orderkey = od.k""",

    "orphans": _w(OD) + f"""SELECT od.pid AS group_id, {_uid('l.l_partkey')} AS user_id FROM {LJ}
WHERE {_uid('l.l_partkey')} NOT IN {USERS}""",

    "ghosts_standard": _GHOST_BASE.format(
        created=_CREATED_STD.format(n2="'N' || ck", l2="c_mktsegment"),
        updated=f"""SELECT {_GID}, k, 1, 'G' || k, 'L' || k, CASE WHEN k % 4 = 3 THEN 'g' || k || '@x.org' END,
   CAST(NULL AS VARCHAR) FROM od WHERE k % 2 = 1"""),

    "ghosts_groups": _GHOST_BASE.format(
        created=_CREATED_STD.format(n2="'Restored'", l2="'User'"),
        updated=f"""SELECT {_GID}, k, 1, CASE WHEN k % 4 = 3 THEN 'G' || k ELSE 'Restored' END,
   CASE WHEN k % 4 = 3 THEN 'L' || k ELSE 'User' END, CASE WHEN k % 4 = 3 THEN 'g' || k || '@x.org' END,
   CAST(NULL AS VARCHAR) FROM od WHERE k % 2 = 1"""),

    "ghosts_processtypes": _GHOST_BASE.format(
        created="""SELECT CASE WHEN ck % 5 = 0 THEN U ELSE 'u' || (ck % 100) END AS id, k, 0 AS slot,
   CASE WHEN ck % 5 = 0 THEN 'F' || ck ELSE 'Ghost' END AS firstname,
   CASE WHEN ck % 5 = 0 THEN c_mktsegment ELSE 'User' END AS lastname,
   CASE WHEN ck % 5 = 0 THEN 'c' || ck || '@x.org' ELSE 'u' || (ck % 100) || '@ghost.local' END AS email,
   CASE WHEN ck % 5 = 0 THEN c_name END AS username
 FROM od WHERE ck % 5 IN (0, 3)""",
        updated=f"""SELECT {_GID}, k, 1, CASE WHEN k % 4 = 3 THEN 'G' || k ELSE 'Ghost' END,
   CASE WHEN k % 4 = 3 THEN 'L' || k ELSE 'User' END,
   CASE WHEN k % 4 = 3 THEN 'g' || k || '@x.org' ELSE {_GID} || '@ghost.local' END,
   CAST(NULL AS VARCHAR) FROM od WHERE k % 2 = 1"""),

    "members_with_ghosts": _w(OD) + f""", g AS (SELECT DISTINCT {_GID} AS id FROM od WHERE k % 2 = 1),
valid AS (SELECT id FROM {USERS} UNION SELECT id FROM g)
SELECT od.pid AS group_id, {_uid('l.l_partkey')} AS user_id FROM {LJ}
WHERE {_uid('l.l_partkey')} IN (SELECT id FROM valid)""",

    "dependency_check": """SELECT 'orders' AS collection, count(*) AS row_count, count(*) > 0 AS ok FROM orders
UNION ALL SELECT 'users', count(*), count(*) > 0 FROM customer""",

    "upsert_last": _w(OD) + f""", t AS (SELECT DISTINCT {_uid('l.l_partkey')} AS id, 'P' || l.l_partkey AS name FROM {LJ}),
i AS (SELECT {_uid('c_custkey')} AS id, 'F' || c_custkey AS name FROM customer)
SELECT id, name FROM t WHERE id NOT IN (SELECT id FROM i) UNION ALL SELECT id, name FROM i""",

    "upsert_first": _w(OD) + f""", t AS (SELECT DISTINCT {_uid('l.l_partkey')} AS id, 'P' || l.l_partkey AS name FROM {LJ}),
i AS (SELECT {_uid('c_custkey')} AS id, 'F' || c_custkey AS name FROM customer)
SELECT id, name FROM t UNION ALL SELECT id, name FROM i WHERE id NOT IN (SELECT id FROM t)""",

    "upsert_batched": """SELECT id, name FROM (
 SELECT c_mktsegment AS id, c_mktsegment || '-' || (c_custkey % 3) AS name,
        row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey // 2000, c_custkey DESC) AS rn
 FROM customer WHERE c_custkey % 7 >= 3) WHERE rn = 1""",

    "strict_insert_rejects": _w(OD, LI) + """SELECT od.pid AS process_id, CAST(x.l_linenumber AS BIGINT) AS line,
 x.pos AS pos, 'duplicate_key' AS reject_reason
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY pos) AS rn
      FROM li WHERE l_linenumber <> 3) x JOIN od ON x.l_orderkey = od.k WHERE x.rn > 1""",

    "null_key_bypass": _w(OD, LI) + """SELECT od.pid AS process_id, CAST(NULL AS BIGINT) AS line, li.pos AS pos
FROM li JOIN od ON li.l_orderkey = od.k WHERE li.l_linenumber = 3
UNION ALL SELECT od.pid, CAST(li.l_linenumber AS BIGINT), min(li.pos)
FROM li JOIN od ON li.l_orderkey = od.k WHERE li.l_linenumber <> 3 GROUP BY od.pid, li.l_linenumber""",

    "sync_members": _w(OD) + f"SELECT od.pid AS group_id, {_uid('l.l_partkey')} AS user_id FROM {LJ}",

    "full_refresh": f"SELECT {_uid('c_custkey')} AS id, 'F' || c_custkey AS name FROM customer",
}

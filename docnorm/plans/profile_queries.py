"""Driver queries for the profiling operators (G1–G28) and their SQL oracles.

The oracles rebuild, per document, which top-level keys the nesting builders emit and
of what kind (``USER_ENTRIES`` / ``ORDER_ENTRIES``), then aggregate like the operator.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import profile as G
from .oracle import LJ, OD, _uid, _w
from .queries import orders_docs, users_docs

# --------------------------------------------------------------------------- Spark side


def field_coverage(spark, d):
    return G.field_coverage(users_docs(spark, d))


def presence_pct(spark, d):
    return G.presence_pct(users_docs(spark, d))


def null_counts(spark, d):
    return G.null_counts(users_docs(spark, d))


def field_examples(spark, d):
    return G.field_examples(users_docs(spark, d))


def array_profile(spark, d):
    return G.array_profile(orders_docs(spark, d))


def array_item_keys(spark, d):
    return G.array_item_keys(orders_docs(spark, d))


def array_distinct_ids(spark, d):
    return G.array_distinct_ids(orders_docs(spark, d))


def object_profile(spark, d):
    return G.object_profile(users_docs(spark, d))


def catalog_frequency(spark, d):
    return G.catalog_frequency(users_docs(spark, d), "area", name_wins="last")


def value_frequency(spark, d):
    return G.value_frequency(users_docs(spark, d), "lastname")


def enum_candidates(spark, d):
    return G.enum_candidates(orders_docs(spark, d), ["lumbreStatusName", "processTypeName", "processTypeId", "customerId"])


def fk_candidates(spark, d):
    return G.fk_candidates(orders_docs(spark, d), ["customerId", "processTypeId", "lumbreNextSigner.id"])


def snapshot_profile(spark, d):
    return G.snapshot_profile(orders_docs(spark, d))


def snapshot_keys(spark, d):
    return G.snapshot_keys(orders_docs(spark, d))


def membership_profile(spark, d):
    return G.membership_profile(orders_docs(spark, d))


def membership_buckets(spark, d):
    return G.membership_buckets(orders_docs(spark, d))


def timestamp_profile(spark, d):
    return G.timestamp_profile(orders_docs(spark, d), ["createdAt", "updatedAt", "created_at", "processDate"])


def timestamp_fields(spark, d):
    return G.timestamp_fields(users_docs(spark, d))


def dynamic_detect(spark, d):
    return G.dynamic_detect(orders_docs(spark, d))


def dynamic_patterns(spark, d):
    return G.dynamic_patterns(orders_docs(spark, d))


def underscore_fields(spark, d):
    return G.underscore_fields(orders_docs(spark, d))


def container_profile(spark, d):
    return G.container_profile(orders_docs(spark, d), "recipients", ["users", "areas", "subareas", "groups", "emails"])


def has_data(spark, d):
    return G.has_data_docs(users_docs(spark, d), "role")


def nonempty_subarray(spark, d):
    return G.nonempty_subarray(orders_docs(spark, d), "internalDocuments")


def bool_distribution(spark, d):
    return G.bool_distribution(orders_docs(spark, d), ["deleted", "lumbreNextSigner.id"])


def access_list_docs(spark, d):
    from ..sources import nest
    return G.access_list_docs(nest.docs(spark, d, "documents"),
                              ["calculatedProps.whoCanAccess.users", "calculatedProps.whoCanAccess.areas",
                               "calculatedProps.whoCanAccess.subareas"])


def nested_distribution(spark, d):
    return G.nested_distribution(orders_docs(spark, d), "documentSteps.position")


def structure_variants(spark, d):
    return G.structure_variants(users_docs(spark, d))


def text_reference_probe(spark, d):
    return G.text_reference_probe(users_docs(spark, d))


def position_sample(spark, d):
    return G.position_sample(users_docs(spark, d))


def optional_fields(spark, d):
    return G.optional_fields(users_docs(spark, d))


def schema_recommendation(spark, d):
    return G.schema_recommendation(users_docs(spark, d))


QUERIES = {k: v for k, v in dict(globals()).items()
           if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_")}

# --------------------------------------------------------------------------- oracles
# Per user document (customer row, ck = c_custkey): key, kind, example text, present when.
_UK = [
    ("_id", "CASE WHEN ck % 2 = 0 THEN 'object' ELSE 'string' END",
     "CASE WHEN ck % 2 = 0 THEN '{$oid}' ELSE U END", "TRUE"),
    ("firstname", "'string'", "'F' || ck", "TRUE"),
    ("lastname", "'string'", "c_mktsegment", "TRUE"),
    ("username", "'string'", "c_name", "ck % 4 <> 0"),
    ("email", "'string'", "'c' || ck || '@x.org'", "TRUE"),
    ("role", "CASE WHEN ck % 7 = 0 THEN 'string' ELSE 'object' END",
     "CASE WHEN ck % 7 = 0 THEN 'text' WHEN ck % 7 = 1 THEN '{}' ELSE '{id,name}' END", "TRUE"),
    ("area", "'object'", "CASE WHEN ck % 2 = 0 THEN '{descripcion,id,name}' ELSE '{id,name}' END", "TRUE"),
    ("subarea", "'object'", "'{id,name}'", "TRUE"),
    ("customer_id", "'integer'", "CAST(CASE WHEN ck % 3 = 0 THEN 0 ELSE c_nationkey + 100 END AS VARCHAR)", "ck % 3 <> 2"),
    ("customerId", "'integer'", "CAST(c_nationkey AS VARCHAR)", "TRUE"),
    ("deleted", "CASE WHEN ck % 3 = 1 THEN 'null' ELSE 'boolean' END",
     "CASE WHEN ck % 3 = 2 THEN 'True' END", "ck % 3 <> 0"),
    ("lumbre_version", "'integer'", "'0'", "ck % 2 = 0"),
    ("lumbreVersion", "'integer'", "CAST(ck % 5 AS VARCHAR)", "TRUE"),
    ("createdAt", "'object'", "'{$date}'", "ck % 2 = 0"),
    ("created_at", "'string'",
     "CASE WHEN ck % 4 = 1 THEN strftime(make_timestamp(2020, ck % 12 + 1, ck % 28 + 1, ck % 24, ck % 60, 0), "
     "'%Y-%m-%dT%H:%M:%SZ') ELSE strftime(make_timestamp(2020, ck % 12 + 1, ck % 28 + 1, ck % 24, ck % 60, 0), "
     "'%Y-%m-%dT%H:%M:%S.000Z') END", "ck % 4 IN (1, 3)"),
    ("updatedBy", "'object'", "'{user}'", "TRUE"),
    ("acctbal", "'float'", "CAST(c_acctbal AS VARCHAR)", "TRUE"),
    ("__v", "'integer'", "CAST(ck % 10 AS VARCHAR)", "TRUE"),
]

USER_BASE = f"""ub AS (SELECT c.c_custkey AS ck, c.c_name, c.c_mktsegment, c.c_nationkey, c.c_acctbal,
  n.n_name, n.n_regionkey, {_uid('c.c_custkey')} AS U
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

USER_ENTRIES = USER_BASE + ",\nue AS (" + "\nUNION ALL ".join(
    f"SELECT ck, '{k}' AS field, {kind} AS kind, {ex} AS ex FROM ub WHERE {cond}" for k, kind, ex, cond in _UK) + ")"

HL = "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = od.k)"

# Per order document: key, kind, present when (dynamic keys carry their key expression).
_OK = [
    ("'_id'", "CASE k % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'string' ELSE 'integer' END", "TRUE"),
    ("'processNumber'", "'integer'", "TRUE"), ("'processTypeName'", "'string'", "TRUE"),
    ("'processTypeId'", "'string'", "TRUE"), ("'customerId'", "'integer'", "TRUE"),
    ("'lumbreStatusName'", "'string'", "TRUE"), ("'totalPrice'", "'float'", "TRUE"),
    ("'deleted'", "CASE WHEN o_orderstatus = 'F' THEN 'boolean' ELSE 'null' END", "o_orderstatus <> 'O'"),
    ("'createdAt'", "CASE WHEN k % 6 = 0 THEN 'object' ELSE 'string' END", "k % 6 <> 5"),
    ("'updatedAt'", "'object'", "TRUE"), ("'created_at'", "'string'", "k % 4 IN (0, 1)"),
    ("'processDate'", "'string'", "TRUE"),
    ("'processStarter'", "CASE WHEN k % 5 <> 0 THEN 'object' ELSE 'null' END", "TRUE"),
    ("'createdBy'", "'object'", "TRUE"), ("'updatedBy'", "'object'", "k % 4 IN (1, 3)"),
    ("'movements'", "'array'", HL), ("'users'", "'array'", "TRUE"), ("'initiatorFields'", "'object'", "TRUE"),
    ("'documents'", "'array'", HL), ("'internalDocuments'", "'array'", f"k % 2 = 0 AND {HL}"),
    ("'lastMovement'", "'object'", "o_orderstatus <> 'O'"), ("'recipients'", "'object'", "TRUE"),
    ("'documentSteps'", "'object'", "TRUE"), ("'lumbreNextSigner'", "'object'", "k % 2 = 0"),
    ("'lumbreNextParticipant'", "'object'", "k % 3 = 0"), ("'lumbreNextReviewer'", "'object'", "k % 3 = 1"),
    ("'campo_' || (k % 3)", "'string'", "TRUE"),
    ("'_' || (k % 4 + 3)", "CASE WHEN k % 2 = 0 THEN 'integer' ELSE 'string' END", "TRUE"),
    ("'extra_9'", "'array'", "TRUE"), ("'obj_8'", "'object'", "k % 5 = 0"), ("'zero_2'", "'integer'", "k % 7 = 0"),
    ("'__v'", "'integer'", "TRUE"),
]

ORDER_ENTRIES = OD + ",\noe AS (" + "\nUNION ALL ".join(
    f"SELECT k, {key} AS field, {kind} AS kind FROM od WHERE {cond}" for key, kind, cond in _OK) + ")"

NL = f"(SELECT count(*) FROM lineitem l WHERE l.l_orderkey = od.k)"

# key signature (sorted keys joined by ',') and key count of every object-valued field of
# the user documents, from the builder's rules
_SIGS = """sigs AS (
  SELECT '_id' AS field, '$oid' AS sig, 1 AS nkeys FROM ub WHERE ck % 2 = 0
  UNION ALL SELECT 'role', CASE WHEN ck % 7 = 1 THEN '' ELSE 'id,name' END,
    CASE WHEN ck % 7 = 1 THEN 0 ELSE 2 END FROM ub WHERE ck % 7 <> 0
  UNION ALL SELECT 'area', CASE WHEN ck % 2 = 0 THEN 'descripcion,id,name' ELSE 'id,name' END,
    CASE WHEN ck % 2 = 0 THEN 3 ELSE 2 END FROM ub
  UNION ALL SELECT 'subarea', 'id,name', 2 FROM ub
  UNION ALL SELECT 'createdAt', '$date', 1 FROM ub WHERE ck % 2 = 0
  UNION ALL SELECT 'updatedBy', 'user', 1 FROM ub)"""

ORACLE = {
    "field_coverage": "WITH " + USER_ENTRIES + """
SELECT field, count(*) AS present, (SELECT count(*) FROM customer) AS total,
 count(*) * 100 / (SELECT count(*) FROM customer) AS pct,
 count(*) FILTER (WHERE kind = 'null') AS nulls, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types,
 regexp_full_match(field, '(.+)_(\\d+)') AS dynamic
FROM ue GROUP BY field""",

    "optional_fields": "WITH " + USER_ENTRIES + """
SELECT field, count(*) AS present, count(*) * 100 / (SELECT count(*) FROM customer) AS pct
FROM ue GROUP BY field HAVING count(*) < (SELECT count(*) FROM customer)""",

    "presence_pct": "WITH " + USER_ENTRIES + """
SELECT field, count(*) AS present, CAST(floor(count(*) * 100 / (SELECT count(*) FROM customer)) AS BIGINT) AS pct
FROM ue GROUP BY field""",

    "null_counts": "WITH " + USER_ENTRIES + """
SELECT field, count(*) FILTER (WHERE kind = 'null') AS nulls FROM ue GROUP BY field""",

    "field_examples": "WITH " + USER_ENTRIES + """,
f AS (SELECT field, substr(ex, 1, 60) AS example, min(ck) AS first_seq FROM ue WHERE kind <> 'null' GROUP BY 1, 2)
SELECT field, rank, example FROM (
  SELECT field, example, CAST(row_number() OVER (PARTITION BY field ORDER BY first_seq, example) AS BIGINT) AS rank
  FROM f) WHERE rank <= 3""",

    "array_profile": _w(OD) + f""", a AS (
  SELECT 'movements' AS field, {NL} AS n, CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = od.k
     AND l.l_linenumber = 3) THEN 'integer' END AS k1,
     CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = od.k AND l.l_linenumber <> 3) THEN 'object' END AS k2
  FROM od WHERE {HL}
  UNION ALL SELECT 'users', {NL} + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END,
     CASE WHEN {NL} + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END > 0 THEN 'string' END, NULL FROM od
  UNION ALL SELECT 'documents', {NL}, 'object', NULL FROM od WHERE {HL}
  UNION ALL SELECT 'internalDocuments', {NL}, 'object', NULL FROM od WHERE k % 2 = 0 AND {HL}
  UNION ALL SELECT 'extra_9', 0, NULL, NULL FROM od)
SELECT field, count(*) AS docs_with_array, count(*) FILTER (WHERE n > 0) AS docs_with_data,
 CAST(min(n) AS BIGINT) AS min_len, CAST(max(n) AS BIGINT) AS max_len, avg(n) AS avg_len,
 coalesce((SELECT string_agg(DISTINCT x, ',' ORDER BY x) FROM (SELECT k1 AS x FROM a a2 WHERE a2.field = a.field
   UNION ALL SELECT k2 FROM a a3 WHERE a3.field = a.field) WHERE x IS NOT NULL), '') AS item_types
FROM a GROUP BY field""",

    "array_item_keys": _w(OD) + f""", c AS (
  SELECT 'movements' AS field, unnest(['at', 'id', 'line', 'qty', 'supp', 'to']) AS item_key,
         (SELECT count(*) FROM {LJ} WHERE l.l_linenumber <> 3) AS n
  UNION ALL SELECT 'documents', 'id', (SELECT count(*) FROM {LJ})
  UNION ALL SELECT 'internalDocuments', 'id', (SELECT count(*) FROM {LJ} WHERE od.k % 2 = 0))
SELECT field, item_key, n, rank FROM (
  SELECT field, item_key, n, CAST(row_number() OVER (PARTITION BY field ORDER BY n DESC, item_key) AS BIGINT) AS rank
  FROM c WHERE n > 0) WHERE rank <= 10""",

    "array_distinct_ids": _w(OD) + f"""SELECT 'movements' AS field, count(DISTINCT l.l_partkey) AS distinct_ids
FROM {LJ} WHERE l.l_linenumber <> 3
UNION ALL SELECT 'documents', count(DISTINCT l.l_partkey) FROM {LJ}
UNION ALL SELECT 'internalDocuments', count(DISTINCT l.l_suppkey) FROM {LJ} WHERE od.k % 2 = 0""",

    "object_profile": "WITH " + USER_BASE + """, o AS (
  SELECT '_id' AS field, ck, unnest(['$oid']) AS sub_key FROM ub WHERE ck % 2 = 0
  UNION ALL SELECT 'role', ck, unnest(['id', 'name']) FROM ub WHERE ck % 7 >= 2
  UNION ALL SELECT 'area', ck, unnest(CASE WHEN ck % 2 = 0 THEN ['descripcion', 'id', 'name'] ELSE ['id', 'name'] END)
    FROM ub
  UNION ALL SELECT 'subarea', ck, unnest(['id', 'name']) FROM ub
  UNION ALL SELECT 'createdAt', ck, unnest(['$date']) FROM ub WHERE ck % 2 = 0
  UNION ALL SELECT 'updatedBy', ck, unnest(['user']) FROM ub),
p AS (SELECT '_id' AS field, count(*) FILTER (WHERE ck % 2 = 0) AS docs_with_object FROM ub
  UNION ALL SELECT 'role', count(*) FILTER (WHERE ck % 7 <> 0) FROM ub
  UNION ALL SELECT 'area', count(*) FROM ub UNION ALL SELECT 'subarea', count(*) FROM ub
  UNION ALL SELECT 'createdAt', count(*) FILTER (WHERE ck % 2 = 0) FROM ub
  UNION ALL SELECT 'updatedBy', count(*) FROM ub),
c AS (SELECT field, sub_key, count(*) AS n FROM o GROUP BY 1, 2)
SELECT c.field, p.docs_with_object, c.sub_key, c.n, c.rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY field ORDER BY n DESC, sub_key) AS BIGINT) AS rank FROM c) c
JOIN p ON c.field = p.field WHERE c.rank <= 10""",

    "catalog_frequency": """SELECT CAST(c_nationkey AS VARCHAR) AS id, count(*) AS n, arg_max(n_name, c_custkey) AS name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c_nationkey <> 0 GROUP BY c_nationkey""",

    "value_frequency": "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1",

    "enum_candidates": _w(OD) + """, v AS (SELECT DISTINCT 'lumbreStatusName' AS field, o_orderstatus AS value FROM od
  UNION ALL SELECT DISTINCT 'processTypeName', o_orderpriority FROM od
  UNION ALL SELECT DISTINCT 'processTypeId', 'pt' || (k % 7) FROM od
  UNION ALL SELECT DISTINCT 'customerId', CAST(ck AS VARCHAR) FROM od),
c AS (SELECT field, count(*) AS distinct_values FROM v GROUP BY field)
SELECT c.field, c.distinct_values, CASE WHEN c.distinct_values <= 10 THEN
  (SELECT string_agg(value, ',' ORDER BY value) FROM v WHERE v.field = c.field) END AS "values" FROM c""",

    "fk_candidates": _w(OD) + """SELECT 'customerId' AS field, count(*) FILTER (WHERE ck <> 0) AS present,
 count(DISTINCT ck) FILTER (WHERE ck <> 0) AS distinct_values FROM od
UNION ALL SELECT 'processTypeId', count(*), count(DISTINCT k % 7) FROM od
UNION ALL SELECT 'lumbreNextSigner.id', count(*) FILTER (WHERE k % 2 = 0), count(DISTINCT U) FILTER (WHERE k % 2 = 0)
FROM od""",

    "snapshot_profile": _w(OD) + f"""SELECT 'createdBy' AS field, count(*) AS present,
 count(*) FILTER (WHERE ck % 5 <> 4) AS with_user, 0::BIGINT AS missing,
 count(DISTINCT CASE WHEN ck % 5 IN (0, 1, 2) THEN U WHEN ck % 5 = 3 THEN 'u' || (ck % 100) END) AS distinct_users
FROM od
UNION ALL SELECT 'updatedBy', count(*) FILTER (WHERE k % 4 IN (1, 3)), count(*) FILTER (WHERE k % 4 IN (1, 3)),
 count(*) FILTER (WHERE k % 4 NOT IN (1, 3)), count(DISTINCT CASE WHEN k % 4 IN (1, 3) THEN {_uid('k // 4')} END)
FROM od""",

    "snapshot_keys": _w(OD) + """SELECT 'createdBy' AS field, 'user' AS sub_key, count(*) AS n FROM od WHERE ck % 5 <> 4
UNION ALL SELECT 'createdBy', 'userAgent', count(*) FROM od WHERE ck % 5 = 0
UNION ALL SELECT 'updatedBy', 'user', count(*) FROM od WHERE k % 4 IN (1, 3)""",

    "membership_profile": _w(OD) + f""", s AS (SELECT k, {NL} + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS n FROM od),
m AS (SELECT {_uid('l.l_partkey')} AS m FROM {LJ} UNION ALL SELECT '' FROM od WHERE k % 5 = 0)
SELECT count(*) AS groups_with_members, sum(n)::BIGINT AS memberships,
 (SELECT count(DISTINCT m) FROM m) AS distinct_members, CAST(min(n) AS BIGINT) AS min_size,
 CAST(max(n) AS BIGINT) AS max_size, avg(n) AS avg_size FROM s WHERE n > 0""",

    "membership_buckets": _w(OD) + f""", s AS (SELECT {NL} + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS n FROM od)
SELECT CASE WHEN n <= 5 THEN '1-5' WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20' ELSE '20+' END AS bucket,
 count(*) AS groups FROM s WHERE n > 0 GROUP BY 1""",

    "timestamp_profile": _w(OD) + """SELECT 'createdAt' AS field, count(*) FILTER (WHERE k % 6 <> 5) AS present,
 string_agg(DISTINCT CASE k % 6 WHEN 0 THEN 'object_date' WHEN 1 THEN 'iso_z' WHEN 4 THEN 'date_text'
   ELSE 'iso_offset' END, ',' ORDER BY CASE k % 6 WHEN 0 THEN 'object_date' WHEN 1 THEN 'iso_z'
   WHEN 4 THEN 'date_text' ELSE 'iso_offset' END) FILTER (WHERE k % 6 <> 5) AS formats FROM od
UNION ALL SELECT 'updatedAt', count(*), 'object_date' FROM od
UNION ALL SELECT 'created_at', count(*) FILTER (WHERE k % 4 IN (0, 1)), 'iso_z' FROM od
UNION ALL SELECT 'processDate', count(*), string_agg(DISTINCT CASE WHEN k % 2 = 1 THEN 'iso_offset' ELSE 'other' END,
 ',' ORDER BY CASE WHEN k % 2 = 1 THEN 'iso_offset' ELSE 'other' END) FROM od""",

    "timestamp_fields": "WITH " + USER_ENTRIES + """
SELECT field, count(*) AS present, CAST(floor(count(*) * 100 / (SELECT count(*) FROM customer)) AS BIGINT) AS pct
FROM ue WHERE regexp_matches(lower(field), 'at|date') GROUP BY field""",

    "dynamic_detect": _w(OD) + """, e AS (
  SELECT k, 'campo_' || (k % 3) AS field, substr(o_orderpriority, 1, 100) AS ex FROM od
  UNION ALL SELECT k, 'extra_9', NULL FROM od
  UNION ALL SELECT k, 'obj_8', NULL FROM od WHERE k % 5 = 0
  UNION ALL SELECT k, 'zero_2', NULL FROM od WHERE k % 7 = 0)
SELECT field, count(*) AS n, array_to_string(list_slice(list(ex ORDER BY k) FILTER (WHERE ex IS NOT NULL), 1, 2), ' | ') AS examples
FROM e GROUP BY field""",

    "dynamic_patterns": _w(OD) + """, e AS (
  SELECT 'campo' AS base, 'campo_' || (k % 3) AS field FROM od
  UNION ALL SELECT 'extra', 'extra_9' FROM od
  UNION ALL SELECT 'obj', 'obj_8' FROM od WHERE k % 5 = 0
  UNION ALL SELECT 'zero', 'zero_2' FROM od WHERE k % 7 = 0),
g AS (SELECT base, count(DISTINCT field) AS variants, count(*)::BIGINT AS occurrences FROM e GROUP BY base)
SELECT base, variants, occurrences, rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY variants DESC, base) AS BIGINT) AS rank FROM g) WHERE rank <= 20""",

    "underscore_fields": _w(OD) + """SELECT '_' || (k % 4 + 3) AS field, count(*) AS n,
 string_agg(DISTINCT CASE WHEN k % 2 = 0 THEN 'int' ELSE 'null/empty' END, ','
   ORDER BY CASE WHEN k % 2 = 0 THEN 'int' ELSE 'null/empty' END) AS types
FROM od GROUP BY 1""",

    "container_profile": _w(OD) + f""", n AS (SELECT k, {NL} AS nl FROM od)
SELECT 'recipients' AS container, 'users' AS sub, count(*) FILTER (WHERE nl > 0) AS docs_with_data,
  sum(nl)::BIGINT AS items FROM n
UNION ALL SELECT 'recipients', 'areas', count(*), count(*)::BIGINT FROM od
UNION ALL SELECT 'recipients', 'subareas', count(*) FILTER (WHERE k % 2 = 1), count(*) FILTER (WHERE k % 2 = 1)::BIGINT
  FROM od
UNION ALL SELECT 'recipients', 'groups', 0::BIGINT, 0::BIGINT
UNION ALL SELECT 'recipients', 'emails', count(*) FILTER (WHERE k % 3 = 0), count(*) FILTER (WHERE k % 3 = 0)::BIGINT
  FROM od""",

    "has_data": f"""SELECT {_uid('c_custkey')} AS id, c_custkey % 7 <> 1 AS has_data FROM customer""",

    "nonempty_subarray": _w(OD) + f"SELECT pid AS id, {NL}::INTEGER AS n FROM od WHERE k % 2 = 0 AND {HL}",

    "bool_distribution": """SELECT 'deleted' AS field, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_true,
 0::BIGINT AS n_false FROM orders
UNION ALL SELECT 'lumbreNextSigner.id', 0::BIGINT, 0::BIGINT""",

    "access_list_docs": """SELECT 'calculatedProps.whoCanAccess.users' AS field, count(*) AS docs_with_list FROM lineitem
UNION ALL SELECT 'calculatedProps.whoCanAccess.areas', count(*) FROM lineitem
UNION ALL SELECT 'calculatedProps.whoCanAccess.subareas', 0::BIGINT""",

    "nested_distribution": """SELECT CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderkey % 4 AS VARCHAR) END AS value,
 count(*) AS n FROM orders GROUP BY 1""",

    "structure_variants": "WITH " + USER_BASE + ", " + _SIGS + """
SELECT field, count(DISTINCT sig) AS variants, count(DISTINCT sig) > 1 AS json_candidate FROM sigs GROUP BY field""",

    "text_reference_probe": """SELECT 'user' AS word, count(*) AS n FROM customer
UNION ALL SELECT 'customer', count(*) FROM customer""",

    "position_sample": f"""WITH n AS (SELECT count(*) AS n FROM customer)
SELECT CASE c_custkey WHEN 0 THEN 'first' WHEN (SELECT n FROM n) // 2 THEN 'middle' ELSE 'last' END AS position,
 c_custkey AS _seq, {_uid('c_custkey')} AS id
FROM customer WHERE c_custkey IN (0, (SELECT n FROM n) // 2, (SELECT n FROM n) - 1)""",

    "schema_recommendation": "WITH " + USER_ENTRIES + ", " + _SIGS + """,
cov AS (SELECT field, count(*) AS present, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types FROM ue GROUP BY field),
obj AS (SELECT field, max(nkeys) AS max_keys, count(DISTINCT sig) AS variants FROM sigs GROUP BY field)
SELECT cov.field,
 CASE WHEN types NOT LIKE '%array%' AND types NOT LIKE '%object%' THEN 'main'
      WHEN obj.max_keys > 3 OR obj.variants > 1 THEN 'jsonb' ELSE 'main' END AS recommendation,
 (types NOT LIKE '%array%' AND types NOT LIKE '%object%' AND present = (SELECT count(*) FROM customer)) AS not_null,
 present, types FROM cov LEFT JOIN obj ON cov.field = obj.field""",
}

"""Nest relational tables into document collections (relational -> nested VARIANT).

The driver tables are flat; the library works on nested documents. These builders
produce two document collections from the given tables, with every quirk the
normalisers must handle (ObjectId wrappers, mixed timestamp formats, missing vs null,
falsy values, mixed-type arrays, dynamic keys, audit snapshots):

  order_docs  one document per ``orders`` row with its ``lineitem`` rows nested
              (processes-like: movements, members, documents, recipients, snapshots ...)
  user_docs   one document per ``customer`` row with nation/region embedded as catalogs

Arrays nest the child rows of one parent row (a document holds its own children, as in
any document store whose documents have a size cap); nothing else is grouped.
Documents are built as Extended JSON text, parsed once, and stored as (``_seq``,
``doc`` VARIANT) parquet in the shared checkpoint folder; queries read them back through
``read_documents`` like any collection at rest (binary VARIANT, no JSON re-parse).
"""
from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import STORE_CONF, ensure_checkpoint_dir, keyed_side, session_conf
from .documents import read_documents

# Timestamp text forms of the fixtures (rendered from the zone-less value, never through
# the session time zone): $date/Z with milliseconds, Z without fraction, Z with one
# fraction digit, ISO with milliseconds (offset appended by the caller), plain, date only.
Z_MS, Z_S, Z_FRAC1, MS, PLAIN, DAY = "z_ms", "z_s", "z_frac1", "ms", "plain", "day"


def stamp(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` text of a timestamp."""
    text = ts.cast("timestamp_ntz").cast("string")
    return F.rpad(F.concat(text, F.when(F.contains(text, F.lit(".")), F.lit("")).otherwise(F.lit(".000000"))), 26, "0")


def tsfmt(ts: Column, form: str) -> Column:
    return stamp_as(stamp(ts), form)


def stamp_as(b: Column, form: str) -> Column:
    date, t = F.substring(b, 1, 10), F.lit("T")
    return {
        Z_MS: F.concat(date, t, F.substring(b, 12, 12), F.lit("Z")),
        Z_S: F.concat(date, t, F.substring(b, 12, 8), F.lit("Z")),
        Z_FRAC1: F.concat(date, t, F.substring(b, 12, 10), F.lit("Z")),
        MS: F.concat(date, t, F.substring(b, 12, 12)),
        PLAIN: F.substring(b, 1, 19),
        DAY: date,
    }[form]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_range(df: DataFrame, key: Column, files: int) -> DataFrame:
    """Flat rows in ``files`` ranges of ``key``, dealt out before documents are built: range
    bounds are sampled, so whatever stands below this exchange runs twice."""
    return df.repartitionByRange(files, key)


def padded(prefix: str, c: Column, digits: int) -> Column:
    """``prefix`` and the key, zero-padded to ``digits``; longer keys stay whole (``lpad`` cuts)."""
    key = c.cast("long")
    text = key.cast("string")
    return (F.when(key < 0, F.format_string(f"{prefix}%0{digits}d", key))
            .when(F.length(text) < digits, F.concat(F.lit(prefix), F.lpad(text, digits, "0")))
            .otherwise(F.concat(F.lit(prefix), text)))


def uid(c: Column) -> Column:
    """User id text of a numeric key: 'u' + at least 6 digits."""
    return padded("u", c, 6)


def obj(**fields: Column | list[Column]) -> Column:
    """A JSON object as a struct. ``to_json`` leaves a NULL field out, so it becomes a missing
    key (a JSON null must be ``jnull()``). A list gives one key several typed alternatives, of
    which at most one is not NULL (see ``choose``)."""
    return F.struct(*[c.alias(k) for k, v in fields.items() for c in (v if isinstance(v, list) else [v])])


def row(**fields: Column) -> Column:
    """As ``obj``, but a NULL field is written as a JSON null."""
    return obj(**{k: choose((v.isNotNull(), v), default=jnull()) for k, v in fields.items()})


def choose(*cases: tuple[Column, Column], default: Column | None = None) -> list[Column]:
    """CASE WHEN whose branches may have different types: a column per branch, NULL unless
    the branch is the first that holds."""
    out, before = [], None
    for cond, value in cases:
        out.append(before.when(cond, value) if before is not None else F.when(cond, value))
        before = before.when(cond, F.lit(None)) if before is not None else F.when(cond, F.lit(None))
    return out if default is None else [*out, before.otherwise(default)]


def item(struct: Column) -> Column:
    """An object as item of an array of mixed types."""
    return F.parse_json(F.to_json(struct))


def var(c: Column) -> Column:
    return c.cast("variant")


def fixed(text: str) -> Column:
    """A fixed JSON value."""
    return F.parse_json(F.lit(text))


def jnull() -> Column:
    return fixed("null")


def _doc(*pairs) -> Column:
    """JSON text of an object built from (key, value) pairs as in ``obj``; a key may repeat if
    at most one of its values is not NULL."""
    return F.to_json(F.struct(*[c.alias(k) for k, v in pairs for c in (v if isinstance(v, list) else [v])]))


def with_text(json: Column, **fields: Column) -> Column:
    """JSON text of an object with more keys, whose values are given as JSON text; NULL ones
    are left out."""
    # cut by bytes: characters would be counted from the start of every document
    inner = F.substring(json.cast("binary"), F.lit(2), F.octet_length(json) - 2).cast("string")
    return F.concat(F.lit("{"), F.concat_ws(",", F.when(inner != "", inner), *[
        F.concat(F.lit(f'"{k}":'), v) for k, v in fields.items()]), F.lit("}"))


def _line_items(of=F.col) -> dict[str, Column]:
    """JSON text of what a ``lineitem`` row adds to the arrays of its order's document; NULL values
    are JSON nulls in all but movements. ``of`` gives the row's column of a name."""
    part, supp, ln = of("l_partkey"), of("l_suppkey"), of("l_linenumber")
    nulls = {"ignoreNullFields": "false"}
    # texts of keys need no escapes, and six calls of to_json a row cost more than the rest
    key = lambda before, c, after: F.concat(F.lit(before), c.cast("string"), F.lit(after))
    return {
        "movement": F.when(ln == 3, F.coalesce(part.cast("string"), F.lit("null"))).otherwise(F.to_json(obj(
            at=tsfmt(of("l_shipdate"), PLAIN), id=part, to=of("l_returnflag"), qty=of("l_quantity"),
            line=ln, supp=supp))),
        "member": F.coalesce(F.concat(F.lit('"'), uid(part), F.lit('"')), F.lit("null")),
        "recipient": F.coalesce(F.concat(key('{"id":"', uid(part), '","name":"P'), key("", part, '"}')),
                                F.lit('{"id":null,"name":null}')),
        "document": F.coalesce(key('{"id":"p', part, '"}'), F.lit('{"id":null}')),
        "internal": F.coalesce(key('{"id":"s', supp, '"}'), F.lit('{"id":null}')),
        "step": F.to_json(obj(title=F.concat(F.lit("T"), ln.cast("string")), description=of("l_returnflag")), nulls),
    }


def instant(o_orderkey: Column, o_orderdate: Column) -> Column:
    """T = order date + (key mod 86400) s + (key mod 1000) ms (a per-document creation instant)."""
    secs = (o_orderkey % 86400).cast("decimal(18,6)") + (o_orderkey % 1000).cast("decimal(18,6)") / 1000
    return o_orderdate.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def build_order_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one processes-like document per order."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    li = table(spark, sf_dir, "lineitem")
    cust = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "n_name", "n_regionkey", "r_name"))
    # plain columns go through every shuffle, sorted by order; their texts, ten times as wide, are
    # rendered behind the last one, which samples what stands below it
    flat = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
    li = li.select("l_orderkey", *flat).repartition(files, "l_orderkey").sortWithinPartitions("l_orderkey")
    lines = li.select("l_orderkey", F.struct(*flat).alias("line")).groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list("line")).alias("lines"))
    x = (o.join(keyed_side(cust), o.o_custkey == cust.c_custkey, "left").repartition(files, "o_orderkey")
         .join(keyed_side(lines), o.o_orderkey == lines.l_orderkey, "left"))
    x = by_range(x, F.col("o_orderkey"), files)
    x = x.withColumn("lines", F.transform("lines", lambda line: F.struct(*[
        text.alias(name) for name, text in _line_items(lambda c: line[c]).items()])))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    # what several keys use is computed once
    x = x.withColumns({"_user": uid(ck), "_at": instant(k, F.col("o_orderdate"))})
    x = x.withColumns({
        "_created": stamp(F.when(k % 6 == 3, F.col("_at") - F.expr("INTERVAL 3 HOURS")).otherwise(F.col("_at"))),
        "_updated": stamp(F.col("_at") + F.expr("INTERVAL 1 DAY")),
        "_ordered": stamp(F.col("o_orderdate"))})
    U, T, od = F.col("_user"), F.col("_created"), F.col("_ordered")
    H = F.lpad(F.hex(k), 24, "0")
    items = {name: F.array_join(F.col("lines")[name], ",") for name in _line_items()}
    listed = {name: F.concat(F.lit("["), text, F.lit("]")) for name, text in items.items()}

    created = choose(
        (k % 6 == 0, obj(**{"$date": stamp_as(T, Z_MS)})),
        (k % 6 == 1, stamp_as(T, Z_S)),
        (k % 6 == 2, F.concat(stamp_as(T, MS), F.lit("+00:00"))),
        (k % 6 == 3, F.concat(stamp_as(T, MS), F.lit("-03:00"))),
        (k % 6 == 4, stamp_as(T, DAY)))
    snapshot_c = choose(
        (ck % 5 == 0, obj(user=obj(id=U, firstname=F.concat(F.lit("F"), ck.cast("string")),
                                   lastname=F.col("c_mktsegment"),
                                   email=F.concat(F.lit("c"), ck.cast("string"), F.lit("@x.org")),
                                   username=F.col("c_name")), userAgent=F.lit("ua"))),
        (ck % 5 == 1, obj(user=U)),
        (ck % 5 == 2, obj(user=obj(_id=obj(**{"$oid": U}), firstName=F.concat(F.lit("N"), ck.cast("string")),
                                   lastName=F.col("c_mktsegment")))),
        (ck % 5 == 3, obj(user=obj(id=F.concat(F.lit("u"), (ck % 100).cast("string"))))),
        default=fixed("{}"))
    # updatedBy of odd orders names user uid(k div 4): two documents per id (first wins),
    # ids beyond the customer range have no user (ghost parents); k%4==1 uses camelCase names
    gid = uid(F.floor(k / 4))
    snapshot_u = choose(
        (k % 4 == 1, obj(user=obj(id=gid, firstName=F.concat(F.lit("G"), k.cast("string")),
                                  lastName=F.concat(F.lit("L"), k.cast("string"))))),
        (k % 4 == 3, obj(user=obj(id=gid, firstname=F.concat(F.lit("G"), k.cast("string")),
                                  lastname=F.concat(F.lit("L"), k.cast("string")),
                                  email=F.concat(F.lit("g"), k.cast("string"), F.lit("@x.org"))))))
    members = F.concat(F.lit("["), F.concat_ws(",", items["member"], F.when(k % 5 == 0, F.lit('""'))), F.lit("]"))
    initiator = obj(status=obj(id=F.col("o_orderstatus"), name=F.col("o_orderpriority")),
                    cust=F.when(k % 4 != 0, obj(id=ck, name=F.col("c_name"))),
                    note=F.concat(F.lit("n"), k.cast("string")))
    last_name = choose((ck % 3 == 0, jnull()), (ck % 3 == 2, F.col("c_mktsegment")))
    last_movement = F.when(F.col("o_orderstatus") != "O", obj(
        origin=obj(user=obj(id=U, firstname=F.concat(F.lit("F"), ck.cast("string")), lastname=last_name)),
        destination=obj(user=obj(id=F.concat(F.lit("d"), k.cast("string")), firstname=F.col("c_mktsegment"),
                                 area=obj(name=F.col("n_name")), subarea=obj(name=F.col("r_name"))))))
    recipients = obj(
        areas=F.array(row(id=F.col("c_nationkey"), name=F.col("n_name"))),
        subareas=choose((k % 2 == 0, F.lit("none")),
                        default=F.array(row(id=F.col("n_regionkey"), name=F.col("r_name")))),
        emails=F.when(k % 3 == 0, F.array(row(id=ck, name=F.concat(F.lit("c"), ck.cast("string"), F.lit("@x.org"))))))
    steps = obj(position=F.when(k % 4 != 3, k % 4))
    json = _doc(
        ("_id", choose((k % 3 == 0, obj(**{"$oid": H})), (k % 3 == 1, H), default=k)),
        ("processNumber", k),
        ("processTypeName", F.col("o_orderpriority")),
        ("processTypeId", F.concat(F.lit("pt"), (k % 7).cast("string"))),
        ("customerId", ck),
        ("lumbreStatusName", F.col("o_orderstatus")),
        ("totalPrice", F.col("o_totalprice")),
        ("deleted", choose((F.col("o_orderstatus") == "F", F.lit(True)), (F.col("o_orderstatus") == "P", jnull()))),
        ("createdAt", created),
        ("updatedAt", obj(**{"$date": stamp_as(F.col("_updated"), Z_MS)})),
        ("created_at", F.when(k % 4 == 0, stamp_as(od, Z_S)).when(k % 4 == 1, stamp_as(od, Z_FRAC1))),
        ("processDate", F.concat(stamp_as(od, PLAIN), F.when(k % 2 == 1, F.lit("-03:00")).otherwise(F.lit("")))),
        ("processStarter", choose((k % 5 != 0, obj(id=ck, name=F.col("c_name"), starterType=F.col("c_mktsegment"))),
                                  default=jnull())),
        ("createdBy", snapshot_c),
        ("updatedBy", snapshot_u),
        ("initiatorFields", initiator),
        ("lastMovement", last_movement),
        ("lumbreNextSigner", F.when(k % 2 == 0, obj(id=U, role=obj(id=F.col("c_mktsegment"), name=F.col("c_name")),
                                                    area=obj(id=F.col("c_nationkey"), name=F.col("n_name"))))),
        ("lumbreNextParticipant", F.when(k % 3 == 0, obj(_id=obj(**{"$oid": U})))),
        ("lumbreNextReviewer", choose((k % 3 == 1, fixed("{}")), (k % 9 == 2, obj(role=obj(id=U))),
                                      (k % 9 == 5, F.lit("someone")),
                                      (k % 9 == 8, fixed('{"id": "", "_id": {"$oid": ""}}')))),
        *[(f"campo_{i}", F.when(k % 3 == i, F.col("o_orderpriority"))) for i in range(-2, 3)],
        *[(f"_{i + 3}", choose(((k % 4 == i) & (k % 2 == 0), ck), (k % 4 == i, F.lit("")))) for i in range(-3, 4)],
        ("extra_9", fixed("[]")),
        ("obj_8", F.when(k % 5 == 0, fixed("{}"))),
        ("zero_2", F.when(k % 7 == 0, F.lit(0))),
        ("__v", k % 3),
    )
    json = with_text(
        json, movements=listed["movement"], users=members, documents=listed["document"],
        internalDocuments=F.when(k % 2 == 0, listed["internal"]),
        recipients=with_text(F.to_json(recipients), users=listed["recipient"]),
        documentSteps=with_text(F.to_json(steps), items=listed["step"]))
    return x.select(k.alias("_seq"), json.alias("json"))


def build_user_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one users-like document per customer."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    x = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    x = by_range(x, F.col("c_custkey"), files)
    ck = F.col("c_custkey")
    U = uid(ck)
    seg = F.col("c_mktsegment")
    role = choose((ck % 7 == 0, F.lit("text")), (ck % 7 == 1, fixed("{}")),
                  (ck % 7 == 2, obj(id=F.lit(""), name=F.lit("empty"))),
                  default=obj(id=seg, name=F.concat(seg, F.lit("-"), (ck % 3).cast("string"))))
    day = F.make_timestamp_ntz(F.lit(2020), (ck % 12 + 1).cast("int"), (ck % 28 + 1).cast("int"),
                               (ck % 24).cast("int"), (ck % 60).cast("int"), F.lit(0))
    json = _doc(
        ("_id", choose((ck % 2 == 0, obj(**{"$oid": U})), default=U)),
        ("firstname", F.concat(F.lit("F"), ck.cast("string"))),
        ("lastname", seg),
        ("username", F.when(ck % 4 != 0, F.col("c_name"))),
        ("email", F.concat(F.lit("c"), ck.cast("string"), F.lit("@x.org"))),
        ("role", role),
        ("area", obj(id=F.col("c_nationkey"), name=F.col("n_name"),
                     descripcion=F.when(ck % 2 == 0, F.concat(F.lit("d"), F.col("n_regionkey").cast("string"))))),
        ("subarea", obj(id=F.col("n_regionkey"), name=F.col("r_name"))),
        ("customer_id", F.when(ck % 3 != 2, F.when(ck % 3 == 0, F.lit(0)).otherwise(F.col("c_nationkey") + 100))),
        ("customerId", F.col("c_nationkey")),
        ("deleted", choose((ck % 3 == 1, jnull()), (ck % 3 == 2, F.lit(True)))),
        ("lumbre_version", F.when(ck % 2 == 0, F.lit(0))),
        ("lumbreVersion", (ck % 5).cast("int")),
        ("createdAt", F.when(ck % 2 == 0, obj(**{"$date": tsfmt(day, Z_MS)}))),
        ("created_at", F.when(ck % 4 == 1, tsfmt(day, Z_S)).when(ck % 4 == 3, tsfmt(day, Z_MS))),
        ("updatedBy", obj(user=obj(id=uid(ck + 1)))),
        ("acctbal", F.col("c_acctbal")),
        ("__v", ck % 10),
    )
    return x.select(ck.alias("_seq"), json.alias("json"))


def build_staff_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one users-like document per ``supplier`` row, with position and signature type."""
    s = by_range(table(spark, sf_dir, "supplier"), F.col("s_suppkey"), files)
    k, nk = F.col("s_suppkey"), F.col("s_nationkey")
    kind = (k % 3).cast("string")
    json = _doc(
        ("_id", obj(**{"$oid": padded("s", k, 6)})),
        ("firstname", F.col("s_name")),
        ("lastname", F.concat(F.lit("L"), k.cast("string"))),
        ("email", F.concat(F.lit("s"), k.cast("string"), F.lit("@x.org"))),
        ("position", obj(id=nk, name=F.concat(F.lit("Position "), nk.cast("string"), F.lit("-"), kind))),
        ("signaturetype", F.when(k % 4 != 0, obj(
            id=F.concat(F.lit("st"), kind), name=F.concat(F.lit("Signature "), kind),
            descripcion=F.when(k % 2 == 0, F.concat(F.lit("since "), k.cast("string")))))),
        ("__v", k % 3),
    )
    return s.select(k.alias("_seq"), json.alias("json"))


# Market segments used as role ids of the process-type fixtures.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def build_processtype_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one processtypes-like document per ``part`` row (no grouping)."""
    p = by_range(table(spark, sf_dir, "part"), F.col("p_partkey"), files)
    k, sz = F.col("p_partkey"), F.col("p_size")
    seg = F.element_at(F.array(*[F.lit(x) for x in SEGMENTS]), (k % 5 + 1).cast("int"))
    role = F.when(k % 6 == 0, F.lit("NOPE")).otherwise(seg)
    json = _doc(
        ("_id", obj(**{"$oid": padded("T", k, 8)})),
        ("typeName", F.col("p_name")),
        ("typeAlias", F.col("p_brand")),
        ("typeNumerator", F.col("p_type")),
        ("published", sz % 2 == 0),
        ("typePrefix", choose((sz % 3 == 0, obj(id=F.lit(""))), default=obj(
            id=F.col("p_brand"), name=F.concat(F.col("p_brand"), F.lit("-"), (k % 3).cast("string"))))),
        ("instanceStarters", obj(
            peopleTypes=F.array(
                obj(id=F.concat(F.lit("P"), (sz % 5).cast("string")), name=F.concat(F.lit("People"), (sz % 5).cast("string"))),
                obj(id=F.concat(F.lit("P"), (sz % 7).cast("string")),  # the name of P6 is missing
                    name=F.when(sz % 7 != 6, F.concat(F.lit("People7-"), (sz % 7).cast("string"))))),
            initiatorTypes=F.array(row(id=F.concat(F.lit("I"), (k % 4).cast("string")),
                                       name=F.concat(F.lit("Init"), (k % 4).cast("string")))))),
        ("instanceActions", obj(
            area=F.array(obj(id=sz % 25, name=F.concat(F.lit("A"), (sz % 25).cast("string")),
                             role=obj(id=role), action=F.lit("R"))),
            subarea=F.array(obj(id=sz % 5, name=F.concat(F.lit("S"), (sz % 5).cast("string")), action=F.lit("W"))))),
        ("instanceActionsEdit", obj(
            area=F.array(obj(id=(sz + 1) % 25, name=F.lit("EA"))),
            subarea=F.array(item(obj(id=(sz + 2) % 7, name=F.lit("ES"))), var(F.lit("no subarea"))),
            role=F.array(obj(id=role, name=F.lit("ER"))))),
        ("processFields", F.array(
            item(obj(id=k * 10, **{"class": F.lit("c")}, componentName=F.lit("x"))),
            fixed('{"class": "noid"}'), fixed('{"id": null}'),
            fixed('{"id": "dup", "class": "first"}'), fixed('{"id": "dup", "class": "second"}'))),
        ("createdBy", obj(user=obj(id=F.concat(F.lit("pt-user-"), (k % 50).cast("string"))))),
        ("__v", k % 3),
    )
    return p.select(k.alias("_seq"), json.alias("json"))


def build_people_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one people-like document per ``supplier`` row (no grouping)."""
    sp = by_range(table(spark, sf_dir, "supplier"), F.col("s_suppkey"), files)
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    day = F.make_timestamp_ntz(F.lit(2021), (k % 12 + 1).cast("int"), (k % 28 + 1).cast("int"), (k % 24).cast("int"),
                               F.lit(0), F.lit(0))
    json = _doc(
        ("_id", obj(**{"$oid": padded("S", k, 8)})),
        ("peopleTypeId", F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("PT"), (n % 4).cast("string")))),
        ("peopleTypeName", F.concat(F.lit("Type"), (n % 4).cast("string"), F.lit("-"), (k % 3).cast("string"))),
        ("peopleTypeAlias", F.concat(F.lit("alias"), (n % 4).cast("string"))),
        ("personIdType", choose((k % 7 == 0, F.lit("text")), default=obj(
            id=F.when(k % 2 == 0, F.lit("DNI")).otherwise(F.lit("CUIT")),
            name=F.concat(F.lit("Doc"), (k % 2).cast("string"), F.lit("-"), (k % 3).cast("string"))))),
        ("personName", F.col("s_name")),
        ("personEmail", F.when(k % 3 != 0, F.concat(F.lit("s"), k.cast("string"), F.lit("@x.org")))),
        ("personId", k.cast("string")),
        ("domicilio_0", F.when(k % 2 == 0, F.concat(F.lit("Street "), k.cast("string")))),
        ("_3", F.when(k % 4 == 0, F.lit(0))),
        ("_4", F.concat(F.lit("v"), k.cast("string"))),
        ("_5", fixed("{}")),
        ("_6", F.when(k % 3 == 0, obj(a=k))),
        ("_8", F.lit("ignored")),
        ("peopleContent", F.col("s_name")),
        ("customerId", n.cast("string")),
        ("createdAt", F.when(k % 2 == 0, obj(**{"$date": tsfmt(day, Z_MS)}))),
        ("updatedAt", F.when(k % 4 == 0, tsfmt(day + F.expr("INTERVAL 1 HOUR"), Z_S))),
        ("deleted", F.when(k % 6 == 0, F.lit(True))),
        ("lumbreVersion", k % 3),
        ("createdBy", obj(user=obj(id=padded("su", k, 5),
                                   firstname=F.concat(F.lit("S"), k.cast("string"))))),
        ("__v", k % 2),
    )
    return sp.select(k.alias("_seq"), json.alias("json"))


def build_listbuilder_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one listbuilder-like document per ``events`` row (no grouping)."""
    ev = by_range(table(spark, sf_dir, "events"), F.col("event_id"), files)
    e, u = F.col("event_id"), F.col("user_id")
    fields = ('{"key": "f1", "label": "L1", "sortable": true}', "7", '{"key": "f2", "label": "L2"}')
    fields = (F.when(e % 2 == 0, fixed(f"[{', '.join([*fields, '{\"key\": \"f1\", \"label\": \"dup\"}'])}]"))
              .otherwise(fixed(f"[{', '.join(fields)}]")))
    json = _doc(
        ("_id", obj(**{"$oid": padded("L", e, 8)})),
        ("alias", F.col("event_type")),
        ("titleList", F.concat(F.lit("List "), e.cast("string"))),
        ("gqlVariables", F.when(e % 5 == 0, fixed("{}")).otherwise(F.parse_json(F.col("props")))),
        ("mode", choose((e % 3 == 0, fixed('{"table": false, "map": true}')), (e % 3 == 2, F.lit("x")))),
        ("lumbreInternal", F.when(e % 4 == 0, F.lit(True))),
        ("fields", fields),
        ("searchOnFieldsSelected", fixed('["a", 5, "b", "a"]')),
        ("searchOnFieldsToSelected", F.array(F.col("event_type"))),
        ("allAvailableFields", F.array(obj(key=F.col("event_type"), label=F.lit("T")))),
        ("items", F.array(obj(name=F.lit("i1")), obj(name=F.lit("")), obj(name=F.lit("i1")),
                          obj(name=F.concat(F.lit("i"), (e % 3).cast("string"))))),
        ("lmPathActions", F.when(e % 2 == 1, fixed('[{"to": "/a", "tooltip": "t", "fontAwesomeIcon": "fa"}]'))),
        ("buttonLinks", fixed('[{"value": "go", "to": "/x", "show": false}, {"value": "back"}]')),
        ("privileges", F.array(obj(id=u, name=F.concat(F.lit("priv"), u.cast("string")),
                                   codigo_privilegio=F.concat(F.lit("C"), u.cast("string"))))),
        ("createdBy", obj(user=obj(id=uid(u)))),
        ("__v", e % 2),
    )
    return ev.select(e.alias("_seq"), json.alias("json"))


def build_formbuilder_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one formbuilder-like document per ``customer`` row (no grouping)."""
    c = by_range(table(spark, sf_dir, "customer"), F.col("c_custkey"), files)
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    elements = F.array(
        item(obj(id=ck, componentName=F.col("c_mktsegment"), **{"class": F.lit("c")},
                 componentProps=choose((ck % 2 == 0, obj(a=ck)), default=fixed("{}")),
                 isHiddenOnPdf=ck % 3 == 0)),
        var(F.lit("not-an-element")),
        item(obj(id=ck * 1.5, componentName=F.lit("second"), hasLabelOnPdf=F.lit(True))))
    priv = obj(id=nk, name=F.concat(F.lit("N"), nk.cast("string")), codigo_privilegio=F.lit("X"))
    json = _doc(
        ("_id", obj(**{"$oid": padded("F", ck, 8)})),
        ("alias", F.col("c_name")),
        ("pageTitleData", F.concat(F.lit("Form "), ck.cast("string"))),
        ("validations", choose((ck % 4 == 0, obj(required=F.lit(True))), default=fixed("[]"))),
        ("created", obj(**{"$date": F.lit("2020-01-02T03:04:05.678Z")})),
        ("formElements", elements),
        ("allowAccess", F.array(priv)),
        ("allowCreate", F.array(priv, priv)),
        ("allowUpdate", F.when(ck % 2 == 0, F.array(
            item(priv), item(obj(id=F.lit("own"), name=F.concat(F.lit("O"), ck.cast("string")))), item(priv)))),
        ("createdBy", obj(user=obj(id=uid(ck)))),
        ("__v", ck % 4),
    )
    return c.select(ck.alias("_seq"), json.alias("json"))


def build_document_docs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """(``_seq``, ``json``) — one documents-like document per ``lineitem`` row (no grouping):
    participants, signers, share lists, viewers, privileges, access lists and movements
    all come from the row's own columns."""
    li = table(spark, sf_dir, "lineitem").withColumn("_seq", F.monotonically_increasing_id())
    li = by_range(li, F.col("_seq"), files)
    o, ln, p, s_, q = (F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                       F.col("l_quantity").cast("bigint"))
    did = F.concat_ws("-", F.concat(F.lit("D"), o.cast("string")), ln.cast("string"), p.cast("string"),
                      s_.cast("string"), q.cast("string"))
    name = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    arr = F.array
    json = _doc(
        ("_id", obj(**{"$oid": did})),
        ("documentNumber", o.cast("string")),
        ("documentName", F.concat(F.lit("Doc "), did)),
        ("documentTypeId", F.col("l_returnflag")),
        ("lumbreTotalSigners", F.when(ln % 2 == 0, ln)),
        ("deleted", F.when(F.col("l_linestatus") == "F", F.lit(True))),
        ("calculatedProps", obj(
            everyoneCanAccess=F.when(ln % 3 == 0, F.lit(False)),
            whoCanAccess=obj(users=arr(uid(p), F.lit(""), uid(s_)),
                             areas=arr(s_ % 25, F.lit(0).cast("bigint"))))),
        ("lumbreSignerReviewer", choose((ln % 2 == 1, obj(id=uid(s_), name=name("S", s_), done=F.lit(True))),
                                        default=fixed("{}"))),
        ("signerPositionMap", F.when(ln % 4 == 0, fixed("{}"))),
        ("participants", arr(obj(id=uid(p), name=name("P", p), action=F.lit("sign")),
                             obj(id=F.lit(""), name=F.lit("x"), action=F.lit(None).cast("string")),
                             obj(id=uid(s_), name=name("S", s_), action=F.lit("view")))),
        ("signers", arr(obj(id=uid(p), name=name("P", p)), obj(id=uid(p), name=F.lit("again")))),
        ("shareWith", arr(obj(id=uid(s_), name=name("S", s_)))),
        ("viewers", obj(users=arr(obj(id=uid(p), name=name("P", p))),
                        areas=arr(obj(id=s_ % 25, name=name("A", s_ % 25))),
                        subareas=F.lit("none"))),
        ("instancePrivileges", obj(area=arr(obj(id=p % 25, name=name("A", p % 25))),
                                   role=arr(obj(id=F.col("l_returnflag"), name=name("R", F.col("l_returnflag")))))),
        ("movements", arr(obj(created_at=obj(**{"$date": tsfmt(F.col("l_shipdate"), Z_MS)}),
                              created_by=choose(
                                  (ln == 5, jnull()), (ln == 6, F.lit("someone")),
                                  default=obj(id=uid(s_), firstname=name("F", s_),
                                              lastname=choose((ln % 2 == 0, F.lit("L")), default=jnull()))),
                              movement=obj(step=ln),
                              documentation=fixed("[]")))),
        ("createdBy", obj(user=obj(id=uid(s_)))),
        *[(f"campo_{i}", F.when(ln % 3 == i, F.lit("x"))) for i in range(-2, 3)],
    )
    # items of several types are joined as text: a VARIANT inside to_json is parsed and written once more
    reviewers = F.concat_ws(
        ",", F.to_json(obj(id=uid(s_), name=name("S", s_), action=F.when(ln % 2 == 0, F.lit("review")))),
        F.to_json(obj(id=uid(s_), name=F.lit("again"))), F.lit('{"name":"no id"}'),
        F.coalesce(F.concat(F.lit('"'), uid(p), F.lit('"')), F.lit("null")))
    json = with_text(json, reviewers=F.when(ln % 3 != 0, F.concat(F.lit("["), reviewers, F.lit("]"))))
    return li.select("_seq", json.alias("json"))


_BUILDERS = {"documents": build_document_docs, "formbuilder": build_formbuilder_docs, "orders": build_order_docs, "users": build_user_docs, "processtypes": build_processtype_docs,
             "people": build_people_docs, "staff": build_staff_docs, "listbuilder": build_listbuilder_docs}


def docs(spark: SparkSession, sf_dir: str, collection: str) -> DataFrame:
    """(``_seq``, ``doc``) of a nested collection built from ``sf_dir``; written once as a
    table in the shared checkpoint folder, then read like any collection at rest."""
    root = ensure_checkpoint_dir(spark)
    # keyed by input folder and by this module's source, so a changed builder rebuilds
    with open(__file__, "rb") as fh:
        src = fh.read()
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode() + src).hexdigest()[:16]
    path = os.path.join(root, "docnorm-collections", tag, collection)
    if not _complete(spark, path):
        # build beside the final folder, then rename: concurrent readers never see a
        # half-written collection and a second builder's rename simply loses
        tmp = f"{path}.tmp-{uuid.uuid4().hex}"
        # in _seq-ordered files sized so that reads split across every core / executor
        built = _BUILDERS[collection](spark, sf_dir, _file_count(spark, sf_dir))
        # parsed once here; the collection at rest is binary VARIANT, read without re-parsing
        with _building(spark):
            built.select("_seq", F.parse_json("json").alias("doc")).write.mode("overwrite").parquet(tmp)
        _rename(spark, tmp, path)
    return read_documents(spark, path, fmt="parquet", text_col="doc", seq_col="_seq")


# Session settings while a collection is built, beside those of documents at rest. A document is
# one expression of hundreds of parts; the one method that Spark fuses them into is beyond what the
# JVM compiles (8000 bytes of code), so such a projection is left to Spark's split form. Rows that
# arrive sorted by their key are grouped as they come, without a hash table.
BUILD_CONF = {**STORE_CONF, "spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.execution.replaceHashWithSortAgg": "true"}


def _building(spark: SparkSession):
    return session_conf(spark, BUILD_CONF)


TARGET_FILE_BYTES = 64 * 1024 * 1024
EXPANSION = 4  # nested JSON documents are a few times larger than the flat parquet input


def _file_count(spark: SparkSession, sf_dir: str) -> int:
    """Output files for a collection: enough for all task slots, and ~64 MB each at scale."""
    p, fs = _fs(spark, sf_dir)
    size = int(fs.getContentSummary(p).getLength())
    return max(2 * spark.sparkContext.defaultParallelism, -(-size * EXPANSION // TARGET_FILE_BYTES))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _complete(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path + "/_SUCCESS")
    return bool(fs.exists(p))


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    s, fs = _fs(spark, src)
    d, _ = _fs(spark, dst)
    if not fs.exists(d):
        fs.rename(s, d)

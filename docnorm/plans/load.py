"""Load a collection into its target tables: dependency check, full refresh or
incremental merge, ghost parents into users, key policies, rejects, validation.

Target tables are parquet folders ``<root>/<schema>/<table>`` on shared storage
(``sources.documents.write_table`` / ``write_jdbc`` write elsewhere). The parsed collection is written once, packed, into the shared
checkpoint folder, so the 5–15 tables of a collection read binary VARIANT instead of
parsing the JSON again, and a lost executor recomputes from the checkpoint, not from
the source scan. A load writes every table aside and switches all of them in one step, so
that a load that dies leaves the tables as they were.
"""
from __future__ import annotations

import json
import os
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..operators import conflict as U
from ..operators import integrity as R
from ..operators import validate as VAL
from ..session import cut_lineage, delete_path, ensure_checkpoint_dir, keep_documents, keyed_side, session_conf
from ..sources.documents import count_documents
from . import collections as CL
from .spec import CAST_ERRORS, Collection, Table, normalise

USERS_MAIN = ("lml_users", "main")


class MissingParents(RuntimeError):
    def __init__(self, report: DataFrame, missing: list[str]):
        super().__init__(f"parent collections missing or empty: {', '.join(missing)}")
        self.report = report
        self.missing = missing


@dataclass
class Store:
    """Target tables under one root folder (shared storage on a cluster).

    A table's folder is ``<root>/<schema>/<table>`` until a version names another one.
    Versions are the files ``<root>/_versions/<n>.json``; the highest ``n`` counts. A load
    writes aside (``stage``) and then adds one version (``publish``), which replaces all its
    tables together. What a version replaces is deleted by the next one, so that readers of
    the old tables can finish. The loads of one store run one after another.
    """
    spark: SparkSession
    root: str

    def _hadoop_path(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, *parts))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _version(self) -> tuple[int, dict]:
        """Number and content of the version that counts: folders of tables, replaced folders."""
        fs, folder = self._hadoop_path("_versions")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        n = max((int(name[:-5]) for name in names if name.endswith(".json")), default=0)
        if not n:
            return 0, {"tables": {}, "replaced": []}
        stream = fs.open(self._hadoop_path("_versions", f"{n}.json")[1])
        try:
            return n, json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def path(self, schema: str, table: str) -> str:
        folder = self._version()[1]["tables"].get(f"{schema}.{table}", os.path.join(schema, table))
        return os.path.join(self.root, folder)

    def exists(self, schema: str, table: str) -> bool:
        fs, done = self._hadoop_path(self.path(schema, table), "_SUCCESS")
        return bool(fs.exists(done))

    def stage(self, load_id: str, schema: str, table: str, df: DataFrame) -> None:
        """Write the table's next content aside; readers don't see it before ``publish``."""
        df.write.mode("overwrite").parquet(os.path.join(self.root, "_loads", load_id, schema, table))

    def publish(self, load_id: str, tables: list[tuple[str, str]]) -> None:
        """Switch the staged tables in, all at once: a new version appears by one rename."""
        n, state = self._version()
        for folder in state["replaced"]:
            fs, path = self._hadoop_path(folder)
            fs.delete(path, True)
        old = [state["tables"].get(f"{s}.{t}", os.path.join(s, t)) for s, t in tables]
        new = {f"{s}.{t}": os.path.join("_loads", load_id, s, t) for s, t in tables}
        content = json.dumps({"tables": {**state["tables"], **new}, "replaced": sorted(set(old) - set(new.values()))})
        fs, draft = self._hadoop_path("_versions", f"_{load_id}")
        out = fs.create(draft, True)
        out.write(bytearray(content, "utf-8"))
        out.close()
        target = self._hadoop_path("_versions", f"{n + 1}.json")[1]
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"another load published version {n + 1} of {self.root}")
        fs.delete(self._hadoop_path("_versions", f"{n - 1}.json")[1], False)

    def discard(self, load_id: str) -> None:
        """Delete what a load staged and did not publish."""
        fs, folder = self._hadoop_path("_loads", load_id)
        fs.delete(folder, True)

    def read(self, schema: str, table: str) -> DataFrame | None:
        if not self.exists(schema, table):
            return None
        return self.spark.read.parquet(self.path(schema, table))

    def write(self, schema: str, table: str, df: DataFrame, reads_itself: bool = False) -> None:
        if reads_itself:
            df = cut_lineage(df)
        df.write.mode("overwrite").parquet(self.path(schema, table))

    def append(self, schema: str, table: str, df: DataFrame) -> None:
        """Add rows; what is there stays untouched."""
        df.write.mode("append").parquet(self.path(schema, table))

    def write_rejects(self, schema: str, table: str, df: DataFrame, load_id: str = "") -> None:
        """Add the rejected rows of one load, marked with its id; a load that is repeated under
        the same id replaces what it had added."""
        path = self.path(schema, f"_rejects_{table}")
        df.write.mode("overwrite").parquet(os.path.join(path, f"load_id={load_id}"))
        fs, done = self._hadoop_path(path, "_SUCCESS")
        fs.create(done, True).close()

    def empty(self, t: Table) -> DataFrame:
        return self.spark.createDataFrame([], ", ".join(f"`{n}` {d}" for n, d in t.schema()))


class CatalogStore(Store):
    """Target tables as catalog tables ``<schema>.<table>`` (databases named like the
    collection schemas), written with ``saveAsTable``; ``root`` is unused."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark, "")

    def path(self, schema: str, table: str) -> str:
        return f"`{schema}`.`{table}`"

    def exists(self, schema: str, table: str) -> bool:
        return bool(self.spark.catalog.tableExists(f"{schema}.{table}"))

    def read(self, schema: str, table: str) -> DataFrame | None:
        return self.spark.table(self.path(schema, table)) if self.exists(schema, table) else None

    def write(self, schema: str, table: str, df: DataFrame, reads_itself: bool = False) -> None:
        if reads_itself:
            df = cut_lineage(df)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        df.write.mode("overwrite").format("parquet").saveAsTable(self.path(schema, table))

    def _staged(self, load_id: str, schema: str, table: str) -> str:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        return os.path.join(self.spark.catalog.getDatabase(f"`{schema}`").locationUri, "_loads", load_id, table)

    def stage(self, load_id: str, schema: str, table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self._staged(load_id, schema, table))

    def publish(self, load_id: str, tables: list[tuple[str, str]]) -> None:
        """One catalog call a table: each shows its old or its new content at any time."""
        for schema, table in tables:
            name, folder = self.path(schema, table), self._staged(load_id, schema, table)
            if self.exists(schema, table):
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
                self.spark.catalog.refreshTable(name)
            else:
                self.spark.catalog.createTable(name, path=folder, source="parquet")

    def discard(self, load_id: str) -> None:
        """Staged folders of a catalog lie in their databases and go with these."""

    def write_rejects(self, schema: str, table: str, df: DataFrame, load_id: str = "") -> None:
        self.append(schema, f"_rejects_{table}", df.withColumn("load_id", F.lit(load_id)))

    def append(self, schema: str, table: str, df: DataFrame) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        df.write.mode("append").format("parquet").saveAsTable(self.path(schema, table))


def dependency_report(store: Store, coll: Collection) -> DataFrame | None:
    """R4 over the target store: one row per parent collection main table."""
    parts = {}
    for dep in coll.depends:
        p = CL.COLLECTIONS[dep]
        df = store.read(p.name, "main")
        parts[dep] = df if df is not None else store.empty(p.main)
    return R.dependency_check(parts) if parts else None


def _users_schema():
    return CL.USERS.main.schema()


def ghosts_as_users(ghosts: DataFrame) -> DataFrame:
    """V9: ghost rows shaped as users.main (absent columns NULL, deleted TRUE)."""
    return VAL.with_defaults(ghosts, _users_schema())


# Shuffle files of a load's jobs go with each job.
LOAD_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _in_load_conf(load):
    @wraps(load)
    def run(spark: SparkSession, *args, **kwargs):
        with session_conf(spark, LOAD_CONF):
            return load(spark, *args, **kwargs)
    return run


@_in_load_conf
def load_collection(spark: SparkSession, source: str, docs: DataFrame, store: Store, run_ts: Column | None = None,
                    refresh: bool = True, check_parents: bool = True, salt: int = 1, parallel: int = 1,
                    unparsed: DataFrame | None = None, load_id: str | None = None) -> DataFrame:
    """Load one collection. Returns (table, rows) for every written table and, when there are
    any, ``_rejects_documents`` with the number of ``unparsed`` documents and ``_rejects_casts``
    with that of the values lost by a cast.

    refresh=True   U7: main and its child tables are replaced, tables of other collections
                   that refer to them are emptied (``refresh_tables``); catalogs are merged
                   (stale catalog rows survive, as with the source tool).
    refresh=False  incremental: main merged by its policy; a document whose main row is taken
                   brings its whole set of child rows, one whose main row is turned away
                   (first-wins, strict) changes no child row; catalogs merged.

    The rows of a table written as they come, and the values that its column types could not
    hold, are counted in the pass that writes them; only a table with such values is read once
    more, to add them to ``_rejects_casts`` (table, key, column, raw JSON). A merged table is.
    All tables are written aside and switched in together; ghost users, to whom they may refer,
    are added to users.main before, whose other rows are not rewritten. Rejected rows are added
    to ``_rejects_<table>`` with the id of the load (``load_id``: one that stays the same when a
    load is repeated keeps it from adding them twice).
    """
    coll = CL.COLLECTIONS[source]
    if check_parents:
        rep = dependency_report(store, coll)
        if rep is not None:
            missing = [r["collection"] for r in rep.where(~F.col("ok")).select("collection").collect()]
            if missing:
                raise MissingParents(rep, missing)
    load_id = load_id or f"load-{uuid.uuid4().hex}"
    if run_ts is None:  # one time for the whole load
        run_ts = F.lit(datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    docs_path = os.path.join(ensure_checkpoint_dir(spark), "docnorm-rows", f"{coll.name}-docs-{uuid.uuid4().hex}")
    docs = keep_documents(docs.select("_seq", "doc"), docs_path)
    users_main = store.read(*USERS_MAIN) if coll.ghosts else None
    parents = {}
    for schema, table in (("lml_users", "areas"), ("lml_users", "subareas"), ("lml_users", "roles")):
        df = store.read(schema, table)
        if df is None and not check_parents:  # asked for: absent parents have no rows
            df = store.empty(CL.USERS.table(table))
        if df is not None:
            parents[f"{schema}.{table}"] = df
    users_ids = users_main.select("id") if users_main is not None else (
        store.empty(CL.USERS.main).select("id") if coll.ghosts else None)
    rows_path = os.path.join(ensure_checkpoint_dir(spark), "docnorm-rows", f"{coll.name}-{uuid.uuid4().hex}")
    result = normalise(coll, docs, users=users_ids, parents=parents, run_ts=run_ts, rows_path=rows_path, salt=salt,
                       materialize=cut_lineage, track_casts=True)
    summary: list[tuple[str, int | None]] = []
    with_errors: list[str] = []
    rejects = defaultdict(list, {name: [rej.drop("_seq", "pos")] for name, rej in result.rejects.items()})
    pk = coll.main.cols[0].name
    main_keys = result.tables["main"].select(F.col(pk))
    held = None if refresh or coll.main.policy == "last" else store.read(coll.name, "main")
    if held is not None:
        main_keys = cut_lineage(main_keys.join(keyed_side(held.select(pk)), pk, "left_anti"))

    def write_table(t: Table) -> tuple[str, int | None]:
        incoming = result.tables[t.name]
        existing = store.read(coll.name, t.name)
        if existing is None or (refresh and not t.catalog):
            written, counted = result.tracked.get(t.name, incoming), Observation()
            lost = [F.sum(F.size(CAST_ERRORS)).alias("lost")] if t.name in result.tracked else []
            store.stage(load_id, coll.name, t.name, written.observe(counted, F.count(F.lit(1)).alias("rows"), *lost).drop(CAST_ERRORS))
            if counted.get.get("lost"):
                with_errors.append(t.name)
            return f"{coll.name}.{t.name}", counted.get["rows"]
        if t.name in result.tracked:
            with_errors.append(t.name)
        if t.catalog:
            # catalogs are parents: merged, never emptied (stale rows survive a refresh)
            out = U.upsert(existing, incoming.withColumn("_seq", F.lit(0)), list(t.key),
                           policy="last" if t.policy == "last" else "first")
        elif t.name == "main" and t.policy == "strict":
            fresh, turned_away = U.strict_insert(incoming.withColumn("_seq", F.lit(0)), list(t.key), existing=existing)
            rejects[t.name].append(turned_away.drop("_seq"))
            out = existing.unionByName(fresh.select(*existing.columns))
        elif t.name == "main":
            out = U.upsert(existing, incoming.withColumn("_seq", F.lit(0)), list(t.key),
                           policy="last" if t.policy == "last" else "first")
        else:
            # a document that arrives again brings its whole child set: the children of
            # every incoming document are replaced (U6 for member tables, same for the rest)
            parent_col = t.sync_by[0] if t.sync_by else t.cols[0].name
            present = main_keys.select(F.col(pk).alias(parent_col))
            if held is not None:
                incoming = incoming.join(keyed_side(present), parent_col, "left_semi").select(*incoming.columns)
            out = U.sync_members(existing, incoming, [parent_col], present)
        store.stage(load_id, coll.name, t.name, out)
        return f"{coll.name}.{t.name}", None

    # the tables of a collection are independent jobs over materialised inputs; with
    # parallel > 1 they are submitted concurrently (useful when many tables are small
    # next to the cluster; on local[8] it measured no gain, so the default is 1)
    staged = [(coll.name, t.name) for t in coll.tables]
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            summary.extend(pool.map(write_table, coll.tables))
        if refresh:
            # what refers to replaced rows goes with them
            for name in refresh_tables(source):
                schema, table = name.split(".", 1)
                if schema != coll.name and store.exists(schema, table):
                    t = next(c for c in CL.COLLECTIONS.values() if c.name == schema).table(table)
                    store.stage(load_id, schema, table, store.empty(t))
                    staged.append((schema, table))
        if result.ghosts is not None:
            # absent from users by construction, so they are added
            new_users = ghosts_as_users(result.ghosts)
            if users_main is None:
                store.stage(load_id, *USERS_MAIN, new_users)
                staged.append(USERS_MAIN)
            else:
                store.append(*USERS_MAIN, new_users.select(*users_main.columns))
        for name, parts in rejects.items():
            store.write_rejects(coll.name, name, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), load_id)
        store.publish(load_id, staged)
    except BaseException:
        store.discard(load_id)
        delete_path(spark, docs_path)
        raise
    rows = [(n, store.read(*n.split(".", 1)).count() if written is None else written) for n, written in summary]
    if with_errors:
        lost = cut_lineage(reduce(DataFrame.unionByName, [_cast_errors(t, result.tracked[t.name]) for t in coll.tables if t.name in with_errors]))
        if n := lost.count():
            store.write_rejects(coll.name, "casts", lost, load_id)
            rows.append((f"{coll.name}._rejects_casts", n))
    delete_path(spark, rows_path)
    delete_path(spark, docs_path)
    if unparsed is not None:
        unparsed = cut_lineage(unparsed)
        if n := unparsed.count():
            store.write_rejects(coll.name, "documents", unparsed, load_id)
            rows.append((f"{coll.name}._rejects_documents", n))
    if result.ghosts is not None:
        rows.append(("lml_users.main(ghosts)", result.ghosts.count()))
    return spark.createDataFrame(rows, "table string, rows bigint")


def _cast_errors(t: Table, tracked: DataFrame) -> DataFrame:
    """(table, key, column, raw) of the values lost by a cast; the key is the first column's."""
    key = F.col(t.cols[0].name).cast("string").alias("key")
    return (tracked.where(F.size(CAST_ERRORS) > 0).select(F.lit(t.name).alias("table"), key, F.explode(CAST_ERRORS).alias("e"))
            .select("table", "key", "e.column", "e.raw"))


def validate_collection(store: Store, source: str) -> DataFrame:
    """V3/V4/V5/V7 over the loaded tables of a collection: (table, check, column, violations)."""
    coll = CL.COLLECTIONS[source]
    parts = []
    for t in coll.tables:
        df = store.read(coll.name, t.name)
        if df is None:
            continue
        name = f"{coll.name}.{t.name}"
        nn = [c.name for c in t.cols if c.not_null]
        if nn:
            parts.append(VAL.not_null_violations(df, nn).select(F.lit(name).alias("table"), F.lit("not_null").alias("check"),
                                                                "column", "violations"))
        lim = {c.name: c.max_len for c in t.cols if c.max_len and c.dtype == "string"}
        if lim:
            parts.append(VAL.length_overflow(df, lim).select(F.lit(name).alias("table"), F.lit("length").alias("check"),
                                                             "column", "violations"))
        if t.key:
            uv = VAL.unique_violations(df, list(t.key)).agg(F.count(F.lit(1)).alias("violations"))
            parts.append(uv.select(F.lit(name).alias("table"), F.lit("unique").alias("check"),
                                   F.lit(",".join(t.key)).alias("column"), "violations"))
    references = [r for r in CL.foreign_keys() if r.child.startswith(coll.name + ".")]
    names = dict.fromkeys(n for r in references for n in (r.child, r.parent))
    tables = {n: df for n in names if (df := store.read(*n.split(".", 1))) is not None}
    if any(r.child in tables and r.parent in tables for r in references):
        parts.append(VAL.fk_graph_violations(tables, references).select(
            F.col("child").alias("table"), F.concat(F.lit("fk:"), "parent").alias("check"), "column", "violations"))
    return reduce(DataFrame.unionByName, parts)


def refresh_tables(source: str) -> list[str]:
    """Tables emptied by a full refresh of a collection (FK closure of its main)."""
    coll = CL.COLLECTIONS[source]
    return U.refresh_closure(CL.fk_edges(), f"{coll.name}.main")


def reset_all(spark: SparkSession) -> list[str]:
    """U8: drop every collection schema known to the config (catalog-backed targets)."""
    return U.reset_all(spark, [c.name for c in CL.COLLECTIONS.values()])


def load_order() -> list[str]:
    """Parents before children."""
    return R.load_order(CL.dependencies())


def is_empty(docs: DataFrame) -> bool:
    """A4: an empty source still refreshes (empties) the target."""
    return count_documents(docs.limit(1)) == 0

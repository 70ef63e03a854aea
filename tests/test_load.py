"""End-to-end load into a store: refresh, ghosts, idempotence, partition independence."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docnorm.plans import load as L
from docnorm.session import ensure_checkpoint_dir
from docnorm.sources import nest

SF = "/root/testdata/sf0.001"


def run_ts():
    return F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")


def counts(store, schema, tables):
    return {t: store.read(schema, t).count() for t in tables}


def test_load_users_then_processes_is_idempotent(spark):
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    users = nest.docs(spark, SF, "users")
    orders = nest.docs(spark, SF, "orders")
    L.load_collection(spark, "users", users, store, run_ts())
    n_users = store.read("lml_users", "main").count()
    L.load_collection(spark, "processes", orders, store, run_ts(), check_parents=False)
    first = counts(store, "lml_processes", ["main", "movements", "process_documents", "last_movements"])
    ghosts = store.read("lml_users", "main").count() - n_users
    assert ghosts > 0
    L.load_collection(spark, "processes", orders, store, run_ts(), check_parents=False)
    assert counts(store, "lml_processes", ["main", "movements", "process_documents", "last_movements"]) == first
    # the second run finds the ghosts already present: no new ghost rows
    assert store.read("lml_users", "main").count() == n_users + ghosts
    v = L.validate_collection(store, "processes")
    assert v.where((F.col("check") == "unique") & (F.col("violations") > 0)).count() == 0
    assert v.where(F.col("check").startswith("fk:") & (F.col("violations") > 0)).count() == 0


def test_missing_parents_stop_the_load(spark):
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    try:
        L.load_collection(spark, "usersgroups", nest.docs(spark, SF, "orders"), store, run_ts())
        raise AssertionError("expected MissingParents")
    except L.MissingParents as e:
        assert e.missing == ["users"]


def test_results_do_not_depend_on_partitioning(spark):
    from docnorm.plans import spec as S, collections as CL
    docs = nest.docs(spark, SF, "orders")
    a = S.normalise(CL.PROCESSES, docs, run_ts=run_ts()).tables["process_documents"]
    b = S.normalise(CL.PROCESSES, docs.repartition(7), run_ts=run_ts()).tables["process_documents"]
    assert sorted(a.collect()) == sorted(b.collect())


def test_single_pass_rows_equal_per_table_scans(spark):
    from docnorm.plans import spec as S, collections as CL
    docs = nest.docs(spark, SF, "orders")
    parents = {"lml_users.main": spark.createDataFrame([("u000001",), ("u000002",)], "id string")}
    for coll in (CL.PROCESSES, CL.DOCUMENTS, CL.USERSGROUPS):
        lazy = S.normalise(coll, docs, parents=parents, run_ts=run_ts())
        single = S.normalise(coll, docs, parents=parents, run_ts=run_ts(), rows_path=tempfile.mkdtemp(prefix="rows-") + "/r")
        for name in lazy.tables:
            a = sorted(map(str, lazy.tables[name].collect()))
            b = sorted(map(str, single.tables[name].collect()))
            assert a == b, (coll.name, name)


def test_empty_source_still_refreshes(spark):
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    users = nest.docs(spark, SF, "users")
    L.load_collection(spark, "users", users, store, run_ts())
    roles = store.read("lml_users", "roles").count()
    assert store.read("lml_users", "main").count() > 0
    L.load_collection(spark, "users", users.limit(0), store, run_ts())
    assert L.is_empty(users.limit(0))
    assert store.read("lml_users", "main").count() == 0          # main emptied
    assert store.read("lml_users", "roles").count() == roles     # catalogs survive


def test_reset_all_drops_collection_schemas(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lml_people")
    spark.range(1).write.mode("overwrite").saveAsTable("lml_people.t_reset_probe")
    dropped = L.reset_all(spark)
    assert "lml_documents" in dropped and len(dropped) == 8
    assert "lml_people" not in [d.name for d in spark.catalog.listDatabases()]


def test_incremental_reload_replaces_children(spark):
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    orders = nest.docs(spark, SF, "orders")
    L.load_collection(spark, "users", nest.docs(spark, SF, "users"), store, run_ts())
    L.load_collection(spark, "processes", orders, store, run_ts(), check_parents=False)
    first = counts(store, "lml_processes", ["main", "movements", "process_documents", "initiator_fields"])
    L.load_collection(spark, "processes", orders, store, run_ts(), refresh=False, check_parents=False)
    assert counts(store, "lml_processes", ["main", "movements", "process_documents", "initiator_fields"]) == first


def test_catalog_store_and_reset(spark):
    store = L.CatalogStore(spark)
    L.load_collection(spark, "users", nest.docs(spark, SF, "users"), store, run_ts())
    assert spark.table("lml_users.main").count() == store.read("lml_users", "main").count() > 0
    L.reset_all(spark)
    assert not store.exists("lml_users", "main")


def test_concurrent_table_writes_match_sequential(spark):
    a = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    b = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    for store, par in ((a, 1), (b, 4)):
        L.load_collection(spark, "users", nest.docs(spark, SF, "users"), store, run_ts(), parallel=par)
        L.load_collection(spark, "processes", nest.docs(spark, SF, "orders"), store, run_ts(), check_parents=False,
                          parallel=par)
    tables = ["main", "movements", "initiator_fields", "process_documents", "last_movements"]
    assert counts(a, "lml_processes", tables) == counts(b, "lml_processes", tables)


def test_salted_parent_rules_match_plain(spark):
    from docnorm.plans import spec as S, collections as CL
    docs = nest.docs(spark, SF, "orders")
    users = nest.docs(spark, SF, "users").selectExpr("1 as x")
    from docnorm.plans.queries import users_main_ids
    ids = users_main_ids(spark, SF)
    a = S.normalise(CL.USERSGROUPS, docs, users=ids, run_ts=run_ts()).tables["members"]
    b = S.normalise(CL.USERSGROUPS, docs, users=ids, run_ts=run_ts(), salt=5).tables["members"]
    assert sorted(a.collect()) == sorted(b.collect())


def process(k, **more):
    import json
    return (k, json.dumps({"_id": f"p{k}", **more}))


def test_values_lost_by_a_cast_are_reported(spark):
    """A refresh and a merge; null, missing and castable values are no loss, a rejected row's are not kept."""
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))

    def load(items, refresh):
        docs = spark.createDataFrame(items, "_seq long, j string").select("_seq", F.parse_json("j").alias("doc"))
        return {r["table"]: r["rows"] for r in
                L.load_collection(spark, "processes", docs, store, run_ts(), refresh=refresh, check_parents=False).collect()}

    first = load([process(1, deleted="maybe", processDate="2020-01-01"), process(2, deleted=None, processDate="never"),
                  process(3, deleted="true", movements=[{"at": "soon"}, {"at": "2020-02-02"}, {}])], True)
    assert first["lml_processes._rejects_casts"] == 3
    assert (first["lml_processes.main"], first["lml_processes.movements"]) == (3, 3)
    lost = lambda: sorted(tuple(r)[:4] for r in store.read("lml_processes", "_rejects_casts").collect())
    want = [("main", "p1", "deleted", '"maybe"'), ("main", "p2", "process_date", '"never"'), ("movements", "p3", "movement_at", '"soon"')]
    assert lost() == want
    main = {r.process_id: r.deleted for r in store.read("lml_processes", "main").collect()}
    assert main == {"p1": None, "p2": None, "p3": True}
    clean = load([process(4, deleted=False)], False)
    assert "lml_processes._rejects_casts" not in clean and lost() == want
    merged = load([process(5, deleted=[1])], False)
    assert merged["lml_processes._rejects_casts"] == 1 and lost() == sorted([*want, ("main", "p5", "deleted", "[1]")])
    assert store.read("lml_processes", "main").count() == 5
    assert "_cast_errors" not in store.read("lml_processes", "main").columns


def test_a_load_that_dies_changes_nothing(spark):
    """The last table can't be written: the tables before it and the dependants stay as they were."""
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    users, orders = nest.docs(spark, SF, "users"), nest.docs(spark, SF, "orders")
    L.load_collection(spark, "users", users, store, run_ts())
    L.load_collection(spark, "usersgroups", orders, store, run_ts())
    before = counts(store, "lml_users", ["main", "roles"]), counts(store, "lml_usersgroups", ["members"])

    class Broken(L.Store):
        def stage(self, load_id, schema, table, df):
            if table == "members":
                raise OSError("disk full")
            super().stage(load_id, schema, table, df)

    try:
        L.load_collection(spark, "users", users.limit(3), Broken(spark, store.root), run_ts())
        raise AssertionError("expected the write to fail")
    except OSError:
        pass
    assert (counts(store, "lml_users", ["main", "roles"]), counts(store, "lml_usersgroups", ["members"])) == before
    L.load_collection(spark, "users", users.limit(3), store, run_ts())
    assert counts(store, "lml_users", ["main"]) == {"main": 3}
    assert counts(store, "lml_usersgroups", ["members"]) == {"members": 0}


def test_old_folders_go_with_the_next_version(spark):
    import os
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    users = nest.docs(spark, SF, "users")
    held = []
    for n in (5, 4, 3):
        L.load_collection(spark, "users", users.limit(n), store, run_ts())
        held.append(store.path("lml_users", "main"))
    assert [os.path.exists(p) for p in held] == [False, True, True]
    assert sorted(f for f in os.listdir(os.path.join(store.root, "_versions")) if f[0].isdigit()) == ["2.json", "3.json"]


def test_a_repeated_load_adds_its_rejects_once(spark):
    store = L.Store(spark, tempfile.mkdtemp(prefix="store-"))
    docs = spark.createDataFrame([process(1, deleted="maybe")], "_seq long, j string").select("_seq", F.parse_json("j").alias("doc"))
    for load_id in ("batch-1", "batch-1", "batch-2"):
        L.load_collection(spark, "processes", docs, store, run_ts(), check_parents=False, load_id=load_id)
    lost = store.read("lml_processes", "_rejects_casts")
    assert sorted(r.load_id for r in lost.collect()) == ["batch-1", "batch-2"]


def _row_folders(spark):
    root = os.path.join(ensure_checkpoint_dir(spark), "docnorm-rows")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_a_load_keeps_its_documents_packed_and_deletes_them(spark, docs, tmp_path, monkeypatch):  # F4
    kept, cut, before = [], [], _row_folders(spark)
    keep, cut_lineage = L.keep_documents, L.cut_lineage

    def keeping(df, path):
        kept.append(keep(df, path))
        assert [r.j for r in kept[-1].select(F.to_json("doc").alias("j")).collect()] == ['{"_id":"u1","role":{"id":1.5,"name":null}}']
        assert all(f.endswith(".zstd.parquet") for f in kept[-1].inputFiles())
        return kept[-1]

    monkeypatch.setattr(L, "keep_documents", keeping)
    monkeypatch.setattr(L, "cut_lineage", lambda df, **kw: (cut.extend(df.columns), cut_lineage(df, **kw))[1])
    d = docs({"_id": "u1", "role": {"id": 1.5, "name": None}})
    store = L.Store(spark, str(tmp_path / "store"))
    L.load_collection(spark, "users", d, store)
    assert len(kept) == 1 and "doc" not in cut and _row_folders(spark) == before
    assert [r.id for r in store.read("lml_users", "roles").collect()] == ["1.5"]

    def die(*args):
        raise RuntimeError("died")

    monkeypatch.setattr(store, "publish", die)
    with pytest.raises(RuntimeError, match="died"):
        L.load_collection(spark, "users", d, store)
    assert not any("-docs-" in name for name in _row_folders(spark) - before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

"""Plans that must hold on larger tables: no key set goes through the driver."""
from docnorm.operators import conflict as U
from docnorm.operators import integrity as R
from docnorm.operators import validate as VAL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_growing_key_sides_are_not_broadcast(spark):
    rows = spark.createDataFrame([("g", "u1", 0, 0)], "id string, user_id string, _seq long, pos long")
    users = spark.createDataFrame([("u1",)], "id string")
    accepted, rejects = U.strict_insert(rows, ["id", "user_id"], order=["_seq", "pos"])
    tables = {"a": rows, "b": users}
    for df in (accepted, rejects, R.keep_if_parent(rows, "user_id", users, "id"), R.null_if_orphan(rows, "user_id", users, "id"),
               R.orphans(rows, "user_id", users, "id"), R.keep_if_parent(rows, "user_id", users, "id", salt=2),
               U.upsert(users, rows.select("id", "_seq"), "id"), U.upsert(users, rows.select("id", "_seq"), "id", policy="first"),
               U.sync_members(rows, rows, "id"),
               VAL.fk_graph_violations(tables, [VAL.Reference("a", "user_id", "b", "id")])):
        assert "BroadcastExchange" not in plan(df)
        assert "SortMergeJoin" in plan(df)

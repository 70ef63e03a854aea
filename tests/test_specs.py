"""Collection config and schema integrity (the reference's config / schema tests, re-aimed)."""
import re

from docnorm.plans import collections as CL
from docnorm.plans import load as L

SNAKE = re.compile(r"^_{0,2}[a-z][a-z0-9_]*$")


def test_55_tables_in_8_collections():
    assert len(CL.COLLECTIONS) == 8
    assert CL.table_count() == 55


def test_names_are_snake_case_and_unique():
    for c in CL.COLLECTIONS.values():
        assert c.name.startswith("lml_")
        names = [t.name for t in c.tables]
        assert len(set(names)) == len(names)
        assert names[0] == "main"
        for t in c.tables:
            assert SNAKE.match(t.name), t.name
            cols = [x.name for x in t.cols]
            assert len(set(cols)) == len(cols), (c.name, t.name)
            for x in cols:
                assert SNAKE.match(x), (t.name, x)


def test_keys_and_policies_reference_columns():
    for c in CL.COLLECTIONS.values():
        for t in c.tables:
            cols = {x.name for x in t.cols}
            if t.key:
                assert set(t.key) <= cols, (c.name, t.name)
            assert t.policy in ("first", "last", "first_batched", "strict", "sync", "none")
            for fk in t.fks:
                assert set(fk.columns) <= cols
                schema, table = fk.table.split(".")
                parent = [p for p in CL.COLLECTIONS.values() if p.name == schema][0]
                assert table in [x.name for x in parent.tables]


def test_load_order_respects_dependencies():
    order = L.load_order()
    for name, deps in CL.dependencies().items():
        for dep in deps:
            assert order.index(dep) < order.index(name), (dep, name)
    assert order[0] == "users"


def test_truth_source_has_no_parents():
    assert CL.USERS.truth_source and CL.USERS.depends == ()


def test_refresh_of_users_reaches_consumers_not_catalogs():
    closure = L.refresh_tables("users")
    assert "lml_users.main" in closure and "lml_usersgroups.members" in closure
    assert "lml_users.roles" not in closure and "lml_usersgroups.main" not in closure


def test_recommended_conf_scales_with_input():
    from docnorm.session import recommended_conf
    small = recommended_conf(10 * 1024 ** 3, 64)
    big = recommended_conf(100 * 1024 ** 4, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # 2x cores floor
    assert int(big["spark.sql.shuffle.partitions"]) == 409600         # ~256 MB each
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"

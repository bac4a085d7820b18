"""Partition paths, inventories and replacement plans."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfmark.operators import (
    overwrite_partitions,
    partition_inventory,
    partition_plan,
    partitions_of,
    plan_levels,
    plan_summary,
    reloaded_partitions,
    retain_reloaded,
    write_partitioned,
)
from shelfmark.operators.partitions import escape_value
from shelfmark.session import scratch_path
from shelfmark.sources import read_dataset

KEYS = ["idEmpresa", "Ano", "Mes"]
SCHEMA = "idEmpresa string, Ano string, Mes string, v int"


def paths(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "path string")


def listed(frame):
    return sorted(row.path for row in frame.collect())


@pytest.fixture
def odd_values(spark):
    return spark.createDataFrame(
        [
            ("0012", "2024", "01", 1), ("0012", "05/0", "/2", 2), ("0012", None, None, 3),
            ("a%b+c {x}", "20\t24", "01", 4), ("1", "2024", "01", 5), ("12", "2024", "01", 6),
            ("É ü", "2024", "[^]", 7), ("q\"'*?", "=:#\\", "12", 8),
        ],
        SCHEMA,
    )


def test_inventory_spells_paths_as_spark_writes_them(spark, odd_values):
    root = scratch_path(spark, "odd")
    write_partitioned(odd_values, root, KEYS)
    found, made = partition_inventory(spark, root), reloaded_partitions(odd_values, KEYS)
    assert listed(found) == listed(made)
    keys = found.select(*KEYS).exceptAll(odd_values.select(*KEYS))
    assert keys.count() == 0 and found.count() == 8
    assert listed(partition_inventory(spark, root, "1")) == ["idEmpresa=1/Ano=2024/Mes=01"]
    assert listed(partition_inventory(spark, root, "a%b+c {x}")) == [
        f"idEmpresa={escape_value('a%b+c {x}')}/Ano=20%0924/Mes=01"
    ]


def test_partition_values_read_back_as_text(spark, odd_values):
    root = scratch_path(spark, "odd")
    write_partitioned(odd_values.filter("idEmpresa = '0012'"), root, KEYS)
    back = read_dataset(spark, root)
    assert {(row.idEmpresa, row.Ano, row.Mes) for row in back.collect()} == {
        ("0012", "2024", "01"), ("0012", "05/0", "/2"), ("0012", None, None),
    }


def test_empty_value_reads_back_as_null(spark):
    root = scratch_path(spark, "empty")
    write_partitioned(spark.createDataFrame([("T", "", "01", 1)], SCHEMA), root, KEYS)
    assert read_dataset(spark, root).first().Ano is None


def test_inventory_of_a_missing_root_is_empty(spark):
    assert partition_inventory(spark, scratch_path(spark, "nowhere")).count() == 0


def test_listing_skips_markers_and_strangers(spark):
    objects = paths(
        spark, "portal/Vendas/idEmpresa=X/Ano=2024/Mes=01/f.parquet", "portal/Vendas/idEmpresa=X/Ano=2024/Mes=01/g",
        "portal/Vendas/idEmpresa=X/", "portal/Vendas/other/f.parquet", "portal/Vendas/idEmpresa=Y/f.parquet",
    )
    assert listed(partitions_of(objects)) == ["idEmpresa=X/Ano=2024/Mes=01", "idEmpresa=Y"]


def test_semi_join_respects_path_borders(spark):
    existing = paths(spark, "idEmpresa=1/Ano=1/Mes=1/", "idEmpresa=12/Ano=1/Mes=1", "idEmpresa=2")
    assert listed(retain_reloaded(existing, paths(spark, "idEmpresa=1"))) == ["idEmpresa=1/Ano=1/Mes=1"]
    assert listed(retain_reloaded(existing, paths(spark, "idEmpresa=12/Ano=1/", "idEmpresa=2"))) == [
        "idEmpresa=12/Ano=1/Mes=1", "idEmpresa=2",
    ]


months = st.builds(lambda t, m: f"idEmpresa={t}/Ano=2024/Mes={m}", st.sampled_from("AB"), st.sampled_from("123"))
any_path = months | st.builds(lambda t: f"idEmpresa={t}", st.sampled_from("AB"))
relaxed = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@relaxed
@given(st.sets(any_path, max_size=8), st.sets(any_path, min_size=1, max_size=5))
def test_semi_join_equals_prefix_test(spark, existing, reloaded):
    kept = {p for p in existing if any(p == r or p.startswith(r + "/") for r in reloaded)}
    assert listed(retain_reloaded(paths(spark, *existing), paths(spark, *reloaded))) == sorted(kept)


@relaxed
@given(st.sets(months, max_size=8), st.sets(months, min_size=1, max_size=6))
def test_plan_equals_set_algebra(spark, existing, reloaded):
    plan = partition_plan(paths(spark, *existing), paths(spark, *reloaded)).collect()
    tenants = {path.split("/")[0] for path in reloaded}
    mine = {path for path in existing if path.split("/")[0] in tenants}
    actions = {row.path: row.action for row in plan}
    assert len(actions) == len(plan)
    assert {p for p, a in actions.items() if a == "keep"} == mine - reloaded
    assert {p for p, a in actions.items() if a == "replace"} == mine & reloaded
    assert {p for p, a in actions.items() if a == "add"} == reloaded - mine
    for row in plan:
        own = {p for p in mine if p.startswith(row.tenant + "/")}
        assert row.whole_tenant == (bool(own & reloaded) and own <= reloaded)


def test_undated_reload_replaces_the_whole_tenant(spark):
    existing = paths(spark, "idEmpresa=A/Ano=2024/Mes=1", "idEmpresa=B/Ano=2024/Mes=1")
    plan = partition_plan(existing, paths(spark, "idEmpresa=A"))
    assert sorted(tuple(row) for row in plan.collect()) == [
        ("idEmpresa=A", "idEmpresa=A", "add", True),
        ("idEmpresa=A", "idEmpresa=A/Ano=2024/Mes=1", "replace", True),
    ]
    assert [tuple(row) for row in plan_levels(plan).collect()] == [("idEmpresa", "idEmpresa=A")]


def levels(spark, existing, reloaded):
    plan = partition_plan(paths(spark, *existing), paths(spark, *reloaded))
    return {tuple(row) for row in plan_levels(plan).collect()}


def test_levels_of_dated_reloads(spark):
    one, two, new = (f"idEmpresa=A/Ano=2024/Mes={month}" for month in "123")
    assert levels(spark, [one, two], [one]) == {("Mes", one)}
    assert levels(spark, [one, two], [one, two]) == {
        ("Mes", one), ("Mes", two), ("Ano", "idEmpresa=A"), ("idEmpresa", "idEmpresa=A"),
    }
    assert levels(spark, [one], [one, new]) == {("Mes", one), ("Mes", new), ("idEmpresa", "idEmpresa=A")}
    assert levels(spark, [], [one]) == set()


def test_summary_labels(spark):
    rows = [("Mes", "b/"), ("Mes", "a"), ("Mes", "b"), ("idEmpresa", "x")]
    frame = spark.createDataFrame(rows, "level string, path string")
    assert {row.level: (row.partitions, row.label) for row in plan_summary(frame).collect()} == {
        "Mes": (2, "Mes: a ... b (2 partições)"), "idEmpresa": (1, "idEmpresa: x (1 partição)"),
    }


def test_dry_run_writes_nothing(spark, odd_values):
    root = scratch_path(spark, "dry")
    plan = overwrite_partitions(odd_values, root, KEYS, dry_run=True)
    assert {row.action for row in plan.collect()} == {"add"}
    assert partition_inventory(spark, root).count() == 0


def test_inventory_of_an_empty_root_is_empty(spark, tmp_path):
    (tmp_path / "idEmpresa=X" / "Ano=2024").mkdir(parents=True)
    assert partition_inventory(spark, str(tmp_path)).count() == 0
    assert partition_inventory(spark, str(tmp_path), "X").count() == 0


def test_inventory_ignores_unfinished_writes(spark, tmp_path):
    done, open_ = tmp_path / "idEmpresa=X", tmp_path / ".spark-staging-1" / "idEmpresa=Y"
    for folder in (done, open_):
        folder.mkdir(parents=True)
        (folder / "part.parquet").write_bytes(b"x")
    (done / "_SUCCESS").write_bytes(b"")
    assert listed(partition_inventory(spark, str(tmp_path))) == ["idEmpresa=X"]

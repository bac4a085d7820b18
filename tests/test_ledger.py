"""Histories of any shape, listings and footers in tasks, ledger and recovery."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from shelfmark.operators import overwrite_partitions, partition_inventory
from shelfmark.plans import (
    DatasetSpec,
    ledger_entries,
    ledger_state,
    open_intents,
    rebuild_ledger,
    reconcile,
    resume,
    run,
    runner,
)
from shelfmark.plans.ledger import ledger_types
from shelfmark.session import scratch_path
from shelfmark.sources import read_dataset
from shelfmark.sources.footers import Tree, column_history, footers, partition_totals
from shelfmark.sources.listing import delivered_types
from shelfmark.storage import delete_tree, glob_paths

AS_OF = datetime(2024, 1, 15, 12)


def month(number, *columns):
    return DatasetSpec("Vendas", f"SELECT {', '.join([f"'2024-0{number}-05' AS DataVenda", *columns])}")


def load(spark, root, spec, **options):
    return run(spark, [spec], "T1", [root] if isinstance(root, str) else root, as_of=AS_OF, delay=0, **options).first()


@pytest.mark.parametrize("ledger", [False, True])
def test_a_column_that_skips_a_month_keeps_its_type(spark, ledger):
    root = scratch_path(spark, "uneven")
    for spec in (month(1, "1.5D AS Taxa"), month(2), month(3, "2.0D AS Taxa")):
        assert load(spark, root, spec, ledger=ledger).status == "written"
    back = read_dataset(spark, f"{root}/Vendas")
    assert dict(back.dtypes)["Taxa"] == "double"
    assert {(row.Mes, row.Taxa) for row in back.collect()} == {("01", 1.5), ("02", None), ("03", 2.0)}


def test_histories_written_before_are_read_whatever_their_types(spark):
    root = scratch_path(spark, "mixed")
    whole = (month(1, "1.5D AS a", "7 AS b", "1 AS c"), month(2, "2.0D AS a", "'x' AS b"), month(3, "3.0D AS a", "8 AS b", "'z' AS d"))
    for spec in whole:
        assert load(spark, root, spec, on_type_change="allow").status == "written"
    back = read_dataset(spark, f"{root}/Vendas")
    assert {k: v for k, v in back.dtypes if k in "abcd"} == {"a": "double", "b": "string", "c": "bigint", "d": "string"}
    assert sorted((r.Mes, r.a, r.b, r.c, r.d) for r in back.collect()) == [
        ("01", 1.5, "7", 1, None), ("02", 2.0, "x", None, None), ("03", 3.0, "8", None, "z"),
    ]
    types = {k: v.simpleString() for k, v in delivered_types(spark, f"{root}/Vendas/idEmpresa=T1").items()}
    assert {k: types[k] for k in "abcd"} == {"a": "double", "b": "string", "c": "bigint", "d": "string"}
    # A load that is whole again follows the fractions of the past.
    assert load(spark, root, month(4, "9.0D AS a", "'y' AS b")).status == "written"


def test_a_file_that_spark_did_not_write(spark, tmp_path):
    folder = tmp_path / "idEmpresa=T1" / "Ano=2024" / "Mes=01"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"n": pa.array([1, 2]), "s": ["a", "b"]}), folder / "own.parquet")
    [found] = footers(spark, str(tmp_path)).collect()
    assert (found.path, found.file, found.rows) == ("idEmpresa=T1/Ano=2024/Mes=01", "own.parquet", 2)
    assert {(f.name, f.type) for f in found.fields} == {("n", '"long"'), ("s", '"string"')}
    assert read_dataset(spark, str(tmp_path)).count() == 2


def test_tasks_list_folders_and_only_partitions_come_back(spark, tmp_path):
    for tenant in ("A", "B", "C"):
        for number in range(1, 5):
            folder = tmp_path / "portal" / "Vendas" / f"idEmpresa={tenant}" / "Ano=2024" / f"Mes=0{number}"
            folder.mkdir(parents=True)
            for k in range(30):
                (folder / f"part-{k}.parquet").write_bytes(b"")
    tree = Tree(spark, str(tmp_path))
    assert tree.folders().count() == 3
    assert tree.partitions().count() == 12
    inventory = partition_inventory(spark, str(tmp_path))
    assert inventory.count() == 12
    plan = inventory._jdf.queryExecution().optimizedPlan().toString()
    # No relation of files, whose index the driver would hold; one root goes in.
    assert "Relation" not in plan and "binaryFile" not in plan and "MapInArrow" in plan
    assert partition_inventory(spark, f"{tmp_path}/portal/Vendas", "B").count() == 4


def test_history_and_totals_of_footers(spark):
    root = scratch_path(spark, "totals")
    load(spark, root, month(1, "1.5D AS a"))
    load(spark, root, DatasetSpec("Vendas", "SELECT '2024-02-01' AS DataVenda, id AS a FROM range(10)"), on_type_change="allow")
    found = footers(spark, f"{root}/Vendas")
    history = {row.name: row for row in column_history(found).collect()}
    assert history["a"].types == ['"double"', '"long"'] and history["a"].last_path.endswith("Mes=02")
    assert {row.path[-2:]: row.rows for row in partition_totals(found).collect()} == {"01": 1, "02": 10}


def test_ledger_tells_what_the_folders_hold(spark):
    root = scratch_path(spark, "ledger")
    path = f"{root}/Vendas"
    for number in (1, 2, 3, 2):
        assert load(spark, root, month(number, f"{number}.5D AS a"), ledger=True).status == "written"
    assert ledger_entries(spark, path).count() == 4
    state = {row.path for row in ledger_state(ledger_entries(spark, path)).collect()}
    assert state == {row.path for row in partition_inventory(spark, path).collect()}
    assert {row.verdict for row in reconcile(spark, path).collect()} == {"agrees"}
    assert ledger_types(spark, path, "T1")["a"].simpleString() == "double"
    assert read_dataset(spark, path).count() == 3
    assert not open_intents(spark, [root])


def test_reconciliation_sees_lost_changed_and_foreign_partitions(spark):
    root = scratch_path(spark, "audit")
    path = f"{root}/Vendas"
    for number in (1, 2, 3):
        load(spark, root, month(number, "1.5D AS a"), ledger=True)
    tenant = f"{path}/idEmpresa=T1/Ano=2024"
    delete_tree(spark, glob_paths(spark, f"{tenant}/Mes=01/*.parquet")[0])
    spark.range(5).write.mode("append").parquet(f"{tenant}/Mes=02")
    spark.range(5).write.parquet(f"{tenant}/Mes=09")
    found = {row.path[-2:]: (row.verdict, row.rows_entered, row.rows_found) for row in reconcile(spark, path).collect()}
    assert found == {"01": ("missing", 1, None), "02": ("differs", 1, 6), "03": ("agrees", 1, 1), "09": ("unentered", None, 5)}
    rebuild_ledger(spark, path)
    assert {row.path[-2:]: row.verdict for row in reconcile(spark, path).collect()} == {"02": "agrees", "03": "agrees", "09": "agrees"}


def test_an_undated_reload_drops_months_from_the_ledger_too(spark):
    root = scratch_path(spark, "layout")
    path = f"{root}/Vendas"
    load(spark, root, month(1, "1 AS a"), ledger=True)
    undated = DatasetSpec("Vendas", "SELECT 5 AS a")
    assert load(spark, root, undated, ledger=True, on_layout_change="replace").status == "written"
    assert [row.path for row in ledger_state(ledger_entries(spark, path)).collect()] == ["idEmpresa=T1"]
    assert {row.verdict for row in reconcile(spark, path).collect()} == {"agrees"}


def test_a_root_that_failed_is_delivered_later_and_the_other_left_alone(spark, monkeypatch):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    load(spark, [good, bad], month(1, "1.5D AS a"), ledger=True)

    def broken(df, root, *args, **kwargs):
        if root.startswith(bad):
            raise OSError("no space left")
        return overwrite_partitions(df, root, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(runner, "overwrite_partitions", broken)
        row = load(spark, [good, bad], month(2, "2.0D AS a"), ledger=True)
    assert row.status == "failed" and "no space left" in row.error
    [owed] = open_intents(spark, [good, bad])
    assert owed.path == f"{bad}/Vendas" and owed.partitions == ["idEmpresa=T1/Ano=2024/Mes=02"]
    written_before = glob_paths(spark, f"{good}/Vendas/idEmpresa=T1/Ano=*/Mes=*/*.parquet")
    [resumed] = resume(spark, [good, bad]).collect()
    assert (resumed.path, resumed.rows, resumed.delivered, resumed.error) == (f"{bad}/Vendas", 1, True, None)
    assert glob_paths(spark, f"{good}/Vendas/idEmpresa=T1/Ano=*/Mes=*/*.parquet") == written_before
    for root in (good, bad):
        back = read_dataset(spark, f"{root}/Vendas").collect()
        assert sorted((r.Mes, r.a) for r in back) == [("01", 1.5), ("02", 2.0)]
        assert {row.verdict for row in reconcile(spark, f"{root}/Vendas").collect()} == {"agrees"}
    assert not glob_paths(spark, owed.parts[0].path)
    assert resume(spark, [good, bad]).count() == 0


class Killed(BaseException):
    """Stands for a driver that dies: nothing after it runs."""


@pytest.mark.parametrize("moment", ["before the swap", "in the swap", "after the swap"])
def test_a_run_killed_around_the_swap_is_repaired(spark, monkeypatch, moment):
    root = scratch_path(spark, "killed")
    path = f"{root}/Vendas"
    months = "SELECT concat('2024-0', id + 1, '-05') AS DataVenda, {0}D + id AS a FROM range(3)"
    assert load(spark, root, DatasetSpec("Vendas", months.format("0.5")), ledger=True).status == "written"

    def dying(df, target, *args, **kwargs):
        if moment == "after the swap":
            overwrite_partitions(df, target, *args, **kwargs)
        if moment == "in the swap":  # one month gone, one month new, one still old
            delete_tree(spark, f"{target}/idEmpresa=T1/Ano=2024/Mes=01")
            overwrite_partitions(df.filter("Mes = '02'"), target, *args, **kwargs)
            (spark.range(1).write.parquet(f"{target}/.spark-staging-dead/idEmpresa=T1/Ano=2024/Mes=01"))
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(runner, "overwrite_partitions", dying)
        patch.setattr(runner, "discard", lambda spark, staged: None)
        with pytest.raises(Killed):
            load(spark, root, DatasetSpec("Vendas", months.format("7.5")), ledger=True)
    assert len(open_intents(spark, [root])) == 1
    [row] = resume(spark, [root], sweep=True).collect()
    assert row.delivered and row.rows == 3
    back = read_dataset(spark, path).collect()
    assert sorted((r.Mes, r.a) for r in back) == [("01", 7.5), ("02", 8.5), ("03", 9.5)]
    assert {row.verdict for row in reconcile(spark, path).collect()} == {"agrees"}
    assert not open_intents(spark, [root]) and not glob_paths(spark, f"{path}/.spark-staging-*")


def test_a_run_killed_between_entry_and_end_of_its_intent_owes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "late")
    from shelfmark.plans import ledger

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "delete_tree", lambda spark, path: None)
        load(spark, root, month(1, "1.5D AS a"), ledger=True)
    assert glob_paths(spark, f"{root}/Vendas/_ledger/*.intent")
    assert resume(spark, [root]).count() == 0
    assert not glob_paths(spark, f"{root}/Vendas/_ledger/*.intent")


def test_lost_landed_rows_are_reported(spark, monkeypatch):
    root = scratch_path(spark, "lost")

    def broken(*args, **kwargs):
        raise OSError("down")

    with monkeypatch.context() as patch:
        patch.setattr(runner, "overwrite_partitions", broken)
        load(spark, root, month(1, "1.5D AS a"), ledger=True)
    [owed] = open_intents(spark, [root])
    delete_tree(spark, owed.parts[0].path)
    [row] = resume(spark, [root]).collect()
    assert not row.delivered and "gone" in row.error and len(open_intents(spark, [root])) == 1


def test_a_dry_run_delivers_nothing_and_plans_every_root(spark):
    first, second = scratch_path(spark, "dry-a"), scratch_path(spark, "dry-b")
    load(spark, first, month(1, "1 AS a"))
    load(spark, first, month(2, "1 AS a"))
    plans = run(spark, [month(2, "2 AS a")], "T1", [first, second], as_of=AS_OF, dry_run=True).collect()
    assert sorted((r.root == f"{first}/Vendas", r.path[-2:], r.action) for r in plans) == [
        (False, "02", "add"), (True, "01", "keep"), (True, "02", "replace"),
    ]
    assert not glob_paths(spark, second) and read_dataset(spark, f"{first}/Vendas").filter("a = 2").isEmpty()

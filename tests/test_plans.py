"""Physical plans: what is scanned, shuffled and joined."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfmark.contracts import Contract, bundled_contracts
from shelfmark.operators import checks, partition_plan, reloaded_partitions, retain_reloaded
from shelfmark.plans import DatasetSpec, build_dataset, prepare
from shelfmark.plans.dataset import discard
from shelfmark.sources import CatalogSource


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]


@pytest.fixture
def lineitem(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    frame.createOrReplaceTempView("lineitem")
    return frame


SALES = "SELECT l_orderkey AS CodigoVenda, l_shipdate AS DataVenda, l_tax AS Imposto, l_partkey, l_comment FROM (" \
        "SELECT *, l_returnflag AS l_comment FROM lineitem)"


def test_profile_reads_only_the_open_columns(spark, lineitem):
    frame = prepare(CatalogSource().read(spark, SALES), DatasetSpec("Vendas", SALES), "T1")
    whole, bad = checks(frame, bundled_contracts()["Vendas"])
    assert list(whole) == ["Imposto"] and not bad
    plan = plan_of(frame.agg(F.count(F.lit(1)), *whole.values(), *bad.values()))
    assert read_columns(plan) == [{"l_tax"}]
    assert plan.count("Exchange") == 1 and "partial_" in plan


def test_a_dated_dataset_shuffles_once_and_carries_source_columns(spark, lineitem):
    spec = DatasetSpec("Vendas", SALES)
    built = build_dataset(spark, [spec], CatalogSource(), bundled_contracts()["Vendas"], "T1", staging="auto")
    plan = plan_of(built.frame)
    assert plan.count("Exchange") == 1 and "REBALANCE_PARTITIONS_BY_COL" in plan
    below = plan[plan.index("Exchange"):]
    assert "DataHoraAtualizacao" not in below and "CodigoLoja" not in below
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_an_undated_dataset_does_not_shuffle(spark, lineitem):
    spec = DatasetSpec("Fornecedores", "SELECT l_suppkey AS CodigoFornecedor FROM lineitem")
    built = build_dataset(spark, [spec], CatalogSource(), bundled_contracts()["Fornecedores"], "T1", staging="auto")
    plan = plan_of(built.frame)
    assert "Exchange" not in plan
    assert read_columns(plan) == [{"l_suppkey"}]


def test_a_staged_dataset_is_profiled_where_it_lands(spark, lineitem, monkeypatch):
    """No pass over landed rows but the one of each root."""
    monkeypatch.setattr("shelfmark.plans.dataset.profile", lambda *_: pytest.fail("a second pass"))
    spec = DatasetSpec("Vendas", SALES)
    built = build_dataset(spark, [spec], CatalogSource(), bundled_contracts()["Vendas"], "T1")
    assert built.rows == lineitem.count() and "Exchange" not in plan_of(built.frame)
    discard(spark, built.staged)


def test_reloaded_partitions_read_only_the_date(spark, lineitem):
    frame = prepare(CatalogSource().read(spark, SALES), DatasetSpec("Vendas", SALES), "T1")
    plan = plan_of(reloaded_partitions(frame, ["idEmpresa", "Ano", "Mes"]))
    assert read_columns(plan) == [{"l_shipdate"}]
    assert plan.count("HashAggregate") == 2


def test_partition_plan_needs_no_join(spark, lineitem):
    frame = prepare(CatalogSource().read(spark, SALES), DatasetSpec("Vendas", SALES), "T1")
    reloaded = reloaded_partitions(frame, ["idEmpresa", "Ano", "Mes"])
    existing = spark.createDataFrame([("idEmpresa=T1/Ano=1996/Mes=01",)], "path string")
    plan = plan_of(partition_plan(existing, reloaded))
    assert "Join" not in plan and plan.count("FileScan parquet") == 1


def test_semi_join_hashes(spark):
    paths = spark.createDataFrame([("idEmpresa=T1/Ano=1996/Mes=01",)], "path string")
    plan = plan_of(retain_reloaded(paths, paths))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_conform_stays_in_one_projection(spark, lineitem):
    from shelfmark.plans import conform_dataset

    contract = Contract({"l_orderkey": "string", "l_tax": "string", "new": "int64"})
    plan = plan_of(conform_dataset(lineitem, contract))
    assert plan.count("Project") == 1 and "Exchange" not in plan

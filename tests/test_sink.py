"""Writing, replacing and fanning out."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators import (
    LayoutChange,
    cluster_by_month,
    cluster_for_write,
    overwrite_partitions,
    partition_cols,
    partition_inventory,
    write_partitioned,
)
from shelfmark.plans import fan_out
from shelfmark.session import scratch_path, session_conf
from shelfmark.sources import read_dataset

KEYS = ["idEmpresa", "Ano", "Mes"]
SCHEMA = "idEmpresa string, Ano string, Mes string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def landed(spark, root):
    rows = [tuple(row[name] for name in (*KEYS, "v")) for row in read_dataset(spark, root).collect()]
    return sorted(rows, key=str)


def test_partition_columns_follow_the_date_column():
    assert partition_cols("DataVenda", ["DataVenda", "x"]) == KEYS
    assert partition_cols("DataVenda", ["x"]) == partition_cols(None, ["x"]) == ["idEmpresa"]


def test_parquet_layout(spark):
    root = scratch_path(spark, "layout")
    numbers = spark.range(0, 1_200_000, 1, 1).select(F.lit("T").alias("idEmpresa"), (F.col("id") % 10).alias("v"))
    write_partitioned(numbers, root, ["idEmpresa"])
    (file,) = glob.glob(f"{root}/idEmpresa=T/*.parquet")
    meta = pq.ParquetFile(file).metadata
    column = meta.row_group(0).column(0)
    assert meta.row_group(0).num_rows == 500_000 and column.compression == "SNAPPY"
    assert any("DICTIONARY" in encoding for encoding in column.encodings)
    assert pq.ParquetFile(file).schema_arrow.names == ["v"]


def test_tenant_column_is_required(spark):
    with pytest.raises(ValueError, match="idEmpresa"):
        write_partitioned(spark.range(3), scratch_path(spark, "x"), ["idEmpresa"])


def test_other_tenants_and_months_survive(spark):
    root = scratch_path(spark, "replace")
    write_partitioned(frame(spark, ("1", "2024", "01", 1), ("1", "2024", "02", 2), ("12", "2024", "01", 3),
                            ("1", None, None, 4), ("1", "05/0", "/2", 5)), root, KEYS)
    overwrite_partitions(frame(spark, ("1", "2024", "01", 9)), root, KEYS)
    assert {row[3] for row in landed(spark, root)} == {9, 2, 3, 4, 5}
    overwrite_partitions(frame(spark, ("1", None, None, 7), ("1", "05/0", "/2", 8)), root, KEYS)
    assert {row[3] for row in landed(spark, root)} == {9, 2, 3, 7, 8}
    overwrite_partitions(frame(spark, ("1", "2024", "01", 0)).filter("v > 5"), root, KEYS)
    assert {row[3] for row in landed(spark, root)} == {9, 2, 3, 7, 8}


row_lists = st.lists(
    st.tuples(
        st.sampled_from("AB"), st.sampled_from(["2023", "2024"]), st.sampled_from(["01", "02"]), st.integers(0, 9)
    ),
    min_size=1, max_size=8,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(row_lists, row_lists)
def test_replace_is_anti_join_plus_new(spark, old, new):
    root = scratch_path(spark, "property")
    write_partitioned(frame(spark, *old), root, KEYS)
    overwrite_partitions(frame(spark, *new), root, KEYS)
    keys = {row[:3] for row in new}
    assert landed(spark, root) == sorted([row for row in old if row[:3] not in keys] + new, key=str)


def test_layout_change_is_an_error_by_default(spark):
    root = scratch_path(spark, "change")
    dated = frame(spark, ("1", "2024", "01", 1), ("12", "2024", "01", 2))
    write_partitioned(dated, root, KEYS)
    undated = dated.filter("idEmpresa = '1'").drop("Ano", "Mes")
    for tenant in (None, "1"):
        with pytest.raises(LayoutChange, match="idEmpresa=1 "):
            overwrite_partitions(undated, root, ["idEmpresa"], tenant=tenant)
    overwrite_partitions(frame(spark, ("3", "", "", 5)).drop("Ano", "Mes"), root, ["idEmpresa"], tenant="3")
    overwrite_partitions(undated, root, ["idEmpresa"], on_layout_change="replace")
    found = {row.path for row in partition_inventory(spark, root).collect()}
    assert found == {"idEmpresa=1", "idEmpresa=3", "idEmpresa=12/Ano=2024/Mes=01"}
    with pytest.raises(LayoutChange, match="idEmpresa=1 "):
        overwrite_partitions(dated.filter("idEmpresa = '1'"), root, KEYS)
    overwrite_partitions(dated.filter("idEmpresa = '12'"), root, KEYS)
    overwrite_partitions(dated.filter("idEmpresa = '1'"), root, KEYS, on_layout_change="replace")
    found = {row.path for row in partition_inventory(spark, root, "1").collect()}
    assert found == {"idEmpresa=1", "idEmpresa=1/Ano=2024/Mes=01"}
    with pytest.raises(ValueError, match="on_layout_change"):
        overwrite_partitions(dated, root, KEYS, on_layout_change="maybe")


def test_one_bad_root_does_not_stop_the_other(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    good = scratch_path(spark, "good")
    errors = fan_out(frame(spark, ("1", "2024", "01", 1)), [str(blocked / "x"), good], KEYS)
    assert errors[good] is None and errors[str(blocked / "x")]
    assert landed(spark, good) == [("1", "2024", "01", 1)]


def hot_month(spark):
    """240,000 rows of which two thirds fall into one month."""
    other = F.concat(F.lit("2023-0"), F.col("id") % 9 + 1, F.lit("-01"))
    day = F.when(F.col("id") % 3 < 2, "2024-01-05").otherwise(other)
    return spark.range(0, 240_000, 1, 16).select(day.alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def test_a_hot_month_is_cut_into_several_tasks(spark):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    with session_conf(spark, small):
        clustered = cluster_by_month(hot_month(spark), "day")
        root = scratch_path(spark, "hot")
        clustered.write.parquet(root)
    sizes = [pq.ParquetFile(file).metadata.num_rows for file in glob.glob(f"{root}/*.parquet")]
    assert sum(sizes) == 240_000
    assert max(sizes) < 60_000
    assert clustered.columns == ["day", "v"]


def test_small_months_are_not_scattered(spark):
    root = scratch_path(spark, "few")
    keyed = hot_month(spark).select(F.lit("T").alias("idEmpresa"), F.substring("day", 1, 4).alias("Ano"),
                                    F.substring("day", 6, 2).alias("Mes"), "v")
    write_partitioned(cluster_for_write(keyed, KEYS), root, KEYS)
    files = glob.glob(f"{root}/**/*.parquet", recursive=True)
    assert len(files) <= 10 + 4
    assert read_dataset(spark, root).count() == 240_000


def test_many_tenants_are_not_scattered(spark):
    root = scratch_path(spark, "tenants")
    many = spark.range(0, 2000, 1, 8).select((F.col("id") % 20).cast("string").alias("idEmpresa"), "id")
    write_partitioned(cluster_for_write(many, ["idEmpresa"]), root, ["idEmpresa"])
    assert len(glob.glob(f"{root}/*/*.parquet")) == 20


def test_undated_data_is_not_shuffled(spark):
    undated = spark.range(5).select(F.lit("T").alias("idEmpresa"))
    assert cluster_by_month(undated, "absent") is undated

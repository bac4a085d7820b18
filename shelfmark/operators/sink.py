"""Partitioned Parquet delivery that replaces only what is reloaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import MONTH, TENANT, YEAR, quoted
from ..functions.text import first_segment
from ..storage import glob_paths, literal
from .partitions import escape_value, partition_inventory, partition_plan, reloaded_partitions

# Parquet layout of delivered files.
PARQUET_OPTIONS = {
    "compression": "snappy",
    "parquet.enable.dictionary": "true",
    "parquet.block.row.count.limit": "500000",
}


class LayoutChange(ValueError):
    """A dated reload meets undated data of the same tenant, or the reverse."""


def partition_cols(date_col: str | None, columns: Sequence[str]) -> list[str]:
    """Tenant always; year and month only when the data has its date column."""
    return [TENANT, YEAR, MONTH] if date_col and date_col in columns else [TENANT]


def cluster_for_write(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together without making one task per key.

    Adaptive execution cuts a partition that is larger than the advisory size
    into several tasks and packs small ones together, so one holding a third of
    all rows still spreads out. Data of one tenant without months is a single
    partition and needs no clustering.
    """
    return df.hint("rebalance", *[quoted(name) for name in cols])


def write_partitioned(df: DataFrame, root: str, cols: Sequence[str]) -> None:
    """Write below ``root``, replacing exactly the partitions present in ``df``.

    An empty frame has no partitions, so nothing is written or removed.
    """
    missing = [name for name in (TENANT, *cols) if name not in df.columns]
    if missing:
        raise ValueError(f"partition columns missing: {', '.join(missing)}")
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PARQUET_OPTIONS)
        .partitionBy(*cols)
        .parquet(root)
    )


def tenants_laid_out_otherwise(
    spark: SparkSession, df: DataFrame, root: str, cols: Sequence[str], tenant: str | None = None
) -> tuple[int, list[str]]:
    """How many tenants of ``df`` the ``root`` holds in the other layout, and some.

    For one known tenant this lists a single directory. For several it compares
    the inventory with the tenants in the data, and reads the data only when
    some tenant is laid out differently.
    """
    if tenant is not None:
        entry = "*.parquet" if len(cols) > 1 else f"{YEAR}=*"
        folder = f"{TENANT}={escape_value(tenant)}"
        found = glob_paths(spark, f"{literal(root.rstrip('/'))}/{folder}/{entry}")
        return (1, [folder]) if found else (0, [])
    is_dated = F.col("path").contains(f"/{YEAR}=")
    other = partition_inventory(spark, root).filter(~is_dated if len(cols) > 1 else is_dated)
    folders = other.select(first_segment(F.col("path")).alias("path")).distinct()
    if folders.isEmpty():
        return 0, []
    mine = reloaded_partitions(df, cols[:1]).select("path")
    clash = folders.join(mine, "path", "left_semi")
    # Named examples are for the message; the decision rests on the whole count.
    row = clash.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first"), F.max("path").alias("last")).first()
    return row.n, sorted({row.first, row.last} - {None})


def overwrite_partitions(
    df: DataFrame,
    root: str,
    cols: Sequence[str],
    dry_run: bool = False,
    on_layout_change: str = "error",
    tenant: str | None = None,
) -> DataFrame | None:
    """Replace the reloaded partitions at ``root`` and keep the others.

    ``dry_run`` writes nothing and returns the replacement plan. An undated
    reload over months would drop the tenant's whole history, so a change of
    layout is an error unless ``on_layout_change="replace"``. Months written over
    undated rows then leave those rows in place, as no reloaded month covers
    them, and the tenant has to be read folder by folder. ``tenant`` says that
    all rows belong to that tenant, which narrows the look-ups.
    """
    spark = df.sparkSession
    if on_layout_change not in ("error", "replace"):
        raise ValueError(f"unknown on_layout_change {on_layout_change!r}")
    if dry_run:
        return partition_plan(partition_inventory(spark, root, tenant), reloaded_partitions(df, cols))
    if on_layout_change == "error":
        clashes, examples = tenants_laid_out_otherwise(spark, df, root, cols, tenant)
        # Nothing to write changes nothing, whatever its columns.
        if clashes and not df.isEmpty():
            named = ", ".join(examples)
            raise LayoutChange(f"{root}: {named} (of {clashes} in all) would change between tenant and month layout")
    write_partitioned(df, root, cols)
    return None

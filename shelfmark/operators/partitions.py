"""Which partitions exist, which are reloaded, and what a reload does to them.

A partition is its Hive path below the dataset root, ``idEmpresa=X`` or
``idEmpresa=X/Ano=Y/Mes=M``, spelled exactly as Spark writes it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..columns import MONTH, TENANT, YEAR, quoted
from ..functions.text import first_segment, parent_path, without_trailing_slashes
from ..sources.footers import Tree
from ..sources.listing import list_objects

# How a set of partitions is put into one line.
ONE_PARTITION = "%s: %s (1 partição)"
SOME_PARTITIONS = "%s: %s ... %s (%d partições)"

# How Spark spells partition directories.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = [chr(code) for code in range(1, 32)] + list("\"#'*/:=?\\{[]^") + [chr(127)]


def escape_value(value: str | None) -> str:
    """A partition value as it appears in a path."""
    if not value:
        return NULL_PARTITION
    return "".join(f"%{ord(ch):02X}" if ch == "%" or ch in ESCAPED else ch for ch in value)


def _escaped(c: Column) -> Column:
    first = F.replace(c, F.lit("%"), F.lit("%25"))
    text = reduce(lambda t, ch: F.replace(t, F.lit(ch), F.lit(f"%{ord(ch):02X}")), ESCAPED, first)
    # Nearly every value is plain, so the long replacement chain is rarely entered.
    special = c.rlike(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
    return F.when(c.isNull() | (c == ""), NULL_PARTITION).when(special, text).otherwise(c)


def _unescaped(c: Column) -> Column:
    text = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.when(c != NULL_PARTITION, F.when(c.contains("%"), text).otherwise(c))


def partition_path(cols: Sequence[str]) -> Column:
    return F.concat_ws("/", *[F.concat(F.lit(f"{name}="), _escaped(quoted(name))) for name in cols])


def reloaded_partitions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct partitions of new data: the key columns and their ``path``."""
    keys = df.select(*[quoted(name).cast("string").alias(name) for name in cols]).distinct()
    return keys.withColumn("path", partition_path(cols))


def partitions_of(objects: DataFrame) -> DataFrame:
    """Distinct partitions in an object listing: ``path`` and its key values.

    Folder markers and objects outside any tenant are left out; whatever stands
    before the tenant segment (root, portal, dataset) is cut off.
    """
    objects = objects.filter(F.col("path").contains(f"{TENANT}=") & ~F.col("path").endswith("/"))
    below = F.regexp_extract("path", f"({TENANT}=.*)", 1)
    return _with_keys(objects.select(without_trailing_slashes(parent_path(below)).alias("path")).distinct())


def _with_keys(paths: DataFrame) -> DataFrame:
    """Partition paths with the key values that they spell."""

    def key(name: str) -> Column:
        found = F.regexp_extract("path", f"(?:^|/){name}=([^/]*)", 1)
        return _unescaped(F.nullif(found, F.lit(""))).alias(name)

    return paths.filter("path <> ''").select("path", key(TENANT), key(YEAR), key(MONTH))


def partition_inventory(spark: SparkSession, root: str, tenant: str | None = None) -> DataFrame:
    """Partitions present below a dataset root; ``tenant`` narrows the listing.

    Tasks list the folders of a tenant each, and hand back a row for every
    partition, whatever number of files it has.
    """
    if tenant is not None:
        root = f"{root.rstrip('/')}/{TENANT}={escape_value(tenant)}"
    tree = Tree(spark, root)
    return _with_keys(tree.partitions()) if tree.reachable else partitions_of(list_objects(spark, root))


def retain_reloaded(existing: DataFrame, reloaded: DataFrame) -> DataFrame:
    """Existing partitions equal to, or below, a reloaded one.

    Each path is matched through its own ancestors, so this is an equality join
    on hashes; ``idEmpresa=1`` is no ancestor of ``idEmpresa=12``.
    """
    paths = existing.select(without_trailing_slashes(F.col("path")).alias("path"))
    wanted = reloaded.select(without_trailing_slashes(F.col("path")).alias("ancestor")).distinct()
    parts = F.split("path", "/")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
    exploded = paths.distinct().withColumn("ancestor", F.explode(ancestors))
    return exploded.join(wanted, "ancestor", "left_semi").select("path").distinct()


def partition_plan(existing: DataFrame, reloaded: DataFrame) -> DataFrame:
    """What the reload does, as ``(tenant, path, action, whole_tenant)``.

    ``replace`` and ``add`` for reloaded partitions, ``keep`` for the rest of the
    tenants that take part; other tenants are not listed. A reload of the bare
    tenant path replaces everything the tenant has. ``whole_tenant`` is true when
    every existing partition of the tenant is replaced.

    Both inputs are read once and collapse to distinct paths before the shuffle;
    what meets in one tenant's window is its list of months, not its rows.
    """

    def side(paths: DataFrame, is_new: bool) -> DataFrame:
        return paths.select(
            without_trailing_slashes(F.col("path")).alias("path"), F.lit(is_new).alias("is_new")
        )

    paths = (
        side(existing, False)
        .union(side(reloaded, True))
        .groupBy(first_segment(F.col("path")).alias("tenant"), "path")
        .agg(F.bool_or(~F.col("is_new")).alias("is_old"), F.bool_or("is_new").alias("is_new"))
    )
    of_tenant = Window.partitionBy("tenant")
    action = (
        F.when(~F.col("is_old"), "add")
        .when(F.col("is_new") | F.col("undated"), "replace")
        .otherwise("keep")
    )
    return (
        paths.withColumn("takes_part", F.bool_or("is_new").over(of_tenant))
        .withColumn("undated", F.bool_or(F.col("is_new") & (F.col("path") == F.col("tenant"))).over(of_tenant))
        .filter("takes_part")
        .select("tenant", "path", action.alias("action"))
        .withColumn(
            "whole_tenant",
            F.bool_or(F.col("action") == "replace").over(of_tenant)
            & F.bool_and(F.col("action") != "keep").over(of_tenant),
        )
    )


def plan_levels(plan: DataFrame) -> DataFrame:
    """Paths dropped per level, ``(level, path)``, for tenants that hold data.

    ``Mes``: reloaded months. ``Ano``: tenants whose existing months are exactly
    the reloaded ones. ``idEmpresa``: tenants replaced as a whole.
    """
    of_tenant = Window.partitionBy("tenant")
    action, path, tenant = F.col("action"), F.col("path"), F.col("tenant")
    is_month = path.contains(f"{YEAR}=") & path.contains(f"{MONTH}=")

    def drop(test: Column, level: str, what: Column) -> Column:
        return F.when(test, F.struct(F.lit(level).alias("level"), what.alias("path")))

    facts = (
        plan.withColumn("dated", ~F.bool_or((path == tenant) & (action != "keep")).over(of_tenant))
        .withColumn("holds_data", F.bool_or(action != "add").over(of_tenant))
        .withColumn("same_months", F.bool_and(action == "replace").over(of_tenant))
        .filter("holds_data")
    )
    drops = F.array_compact(
        F.array(
            drop(F.col("dated") & is_month & (action != "keep"), MONTH, path),
            drop(F.col("dated") & F.col("same_months"), YEAR, tenant),
            drop(F.col("whole_tenant"), TENANT, tenant),
        )
    )
    return facts.select(F.inline(drops)).distinct()


def plan_summary(levels: DataFrame) -> DataFrame:
    """First, last and number of partitions per level, with a one-line label."""
    path = without_trailing_slashes(F.col("path"))
    ends = levels.groupBy("level").agg(
        F.min(path).alias("first"), F.max(path).alias("last"), F.count_distinct(path).alias("partitions")
    )
    one = F.format_string(ONE_PARTITION, "level", "first")
    many = F.format_string(SOME_PARTITIONS, "level", "first", "last", "partitions")
    return ends.withColumn("label", F.when(F.col("partitions") == 1, one).otherwise(many))

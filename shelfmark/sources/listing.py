"""What a destination already holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import PARTITION_KEYS
from ..storage import glob_paths, literal, path_exists, task_settings
from ..unions import union_parts
from .footers import column_history, footers


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet object below ``root`` as ``(path, length)``.

    Spark lists large trees on the executors and gathers the status of every file
    in the driver; file contents are never opened because the content column is
    not selected. Spark would plan a task per large
    file, so the tasks are merged down to a few per core.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, length bigint")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(literal(root))
        .select("path", "length")
        .coalesce(4 * spark.sparkContext.defaultParallelism)
    )


def read_dataset(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a delivered dataset with its partition values as text.

    Spark would otherwise turn tenant ``0012`` into 12 and month ``01`` into 1.
    Pass the schema when it is known. Otherwise one footer of each partition tells
    the columns, so a month that lacks a column, or that has it under another
    type, is read like the others: whole numbers widen to double, anything else
    to text.
    """
    if schema is not None:
        return _read(spark, root, schema, [root])
    if task_settings(spark, root) is None:
        return _read(spark, root, spark.read.parquet(literal(root)).schema, [root])
    found = footers(spark, root, one_each=True)
    history = column_history(found).collect()
    if not history:
        return _read(spark, root, spark.read.parquet(literal(root)).schema, [root])
    latest = max(row.last_path for row in history)
    order = sorted(history, key=lambda row: (row.last_path != latest, row.place if row.last_path == latest else 0, row.name))
    keys = [name for name in PARTITION_KEYS if f"{name}=" in latest]

    def shaped(kinds: dict[str, str]) -> T.StructType:
        fields = [T.StructField(row.name, _type(kinds.get(row.name, row.types[0]))) for row in order]
        return T.StructType([*fields, *[T.StructField(name, T.StringType()) for name in keys]])

    mixed = [row.name for row in history if len(row.types) > 1]
    if not mixed:
        return _read(spark, root, shaped({}), [root])
    # Partitions by the types they have: few kinds, each read with its own types.
    typed = F.transform(F.filter("fields", lambda f: f["name"].isin(mixed)), lambda f: F.struct(f["name"], f["type"]))
    kinds = found.groupBy(F.sort_array(typed).alias("kind")).agg(F.collect_list("path").alias("paths")).collect()
    base = root.rstrip("/").split(f"/{PARTITION_KEYS[0]}=")[0]
    return union_parts(
        [_read(spark, root, shaped({f[0]: f[1] for f in row.kind}), [f"{base}/{path}" for path in row.paths]) for row in kinds]
    )


def _type(text: str) -> T.DataType:
    """A column type from how footers spell it."""
    return T._parse_datatype_json_string(text)


def _read(spark: SparkSession, root: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    text = [T.StructField(f.name, T.StringType()) if f.name in PARTITION_KEYS else f for f in schema.fields]
    reader = spark.read.schema(T.StructType(text))
    if paths != [root]:
        reader = reader.option("basePath", root)
    return reader.parquet(*map(literal, paths))


def delivered_types(spark: SparkSession, folder: str) -> dict[str, T.DataType]:
    """Column types over all months of a tenant's folder; empty without months.

    One footer of each month is opened, inside tasks. A column that months have as
    bigint and as double counts as double, and one of other mixed types as text. A
    tenant kept without months has no history that a reload would have to agree with.
    """
    if not glob_paths(spark, f"{literal(folder)}/{PARTITION_KEYS[1]}=*"):
        return {}
    if task_settings(spark, folder) is None:
        return _types_of_last_month(spark, folder)
    months = footers(spark, folder, one_each=True).filter(F.col("path").contains(f"/{PARTITION_KEYS[1]}="))
    return {row.name: joined_types(row.types) for row in column_history(months).collect()}


def joined_types(spelled: list[str]) -> T.DataType:
    """The one type that values of all these types widen to."""
    types = list(map(_type, spelled))
    if len(types) == 1:
        return types[0]
    numeric = all(isinstance(found, (T.LongType, T.DoubleType)) for found in types)
    return T.DoubleType() if numeric else T.StringType()


def _types_of_last_month(spark: SparkSession, folder: str) -> dict[str, T.DataType]:
    months = glob_paths(spark, f"{literal(folder)}/{PARTITION_KEYS[1]}=*/{PARTITION_KEYS[2]}=*")
    for month in sorted(months, reverse=True):
        files = glob_paths(spark, f"{literal(month)}/*.parquet")
        if files:
            return {f.name: f.dataType for f in spark.read.parquet(literal(files[0])).schema.fields}
    return {}

"""Name and path scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def without_trailing_slashes(c: Column) -> Column:
    return F.rtrim(c, F.lit("/"))


def first_segment(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def parent_path(path: Column) -> Column:
    """Everything before the last ``/``; empty when there is none."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def without_prefix(path: Column, prefix: Column) -> Column:
    """Path below ``prefix``; unchanged when it lies elsewhere."""
    below = F.startswith(path, F.concat(prefix, F.lit("/")))
    return F.when(below, F.substring(path, F.length(prefix) + 2, F.length(path))).otherwise(path)


def bucket_of(uri: Column, scheme: str = "s3://") -> Column:
    return first_segment(F.replace(uri, F.lit(scheme), F.lit("")))


def destination_kind(c: Column, aliases: bool = True) -> Column:
    """``s3``, ``azure`` or ``ambos`` (both); anything unknown means both."""
    kind = F.lower(F.trim(c))
    known = F.when(kind.isin("s3", "azure"), kind).otherwise("ambos")
    return F.when(kind.isin("aws", "amazon"), "s3").otherwise(known) if aliases else known


def object_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)

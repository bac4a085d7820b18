"""Lookups in nested documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def nested(c: Column, *path: str, default: object = None) -> Column:
    """Field below ``c``; a null at any level gives the default."""
    found = reduce(lambda inner, key: inner.getField(key), path, c)
    return found if default is None else F.coalesce(found, F.lit(default))

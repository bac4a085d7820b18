"""Rows of several frames in one, whose columns may be typed differently."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import quoted
from .functions.numbers import double_to_text

#: Digits behind the point of a decimal that takes bigint and double together.
SCALE = 19


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts; a column typed differently is widened, else made text.

    bigint beside double becomes double if all its integers are doubles too, which
    one aggregation over that column finds out. If some are not, it becomes a decimal
    that holds every bigint, and every double below 10^19 to ``SCALE`` digits behind
    the point; a double that is larger fails the read.
    """
    kinds: dict[str, set[T.DataType]] = {}
    for part in parts:
        for column in part.schema.fields:
            kinds.setdefault(column.name, set()).add(column.dataType)
    numeric = {T.LongType(), T.DoubleType()}
    beside = [name for name, found in kinds.items() if found == numeric]
    wide = {name for part in parts for name in _rounded(part, beside)}

    def aligned(part: DataFrame) -> DataFrame:
        out = []
        for column in part.schema.fields:
            c, found = quoted(column.name), kinds[column.name]
            if column.name in wide:
                c = c.cast(T.DecimalType(38, SCALE))
            elif len(found) > 1 and found <= numeric:
                c = _exact_double(c, column)
            elif len(found) > 1:
                c = double_to_text(c) if isinstance(column.dataType, T.DoubleType) else c.cast("string")
            out.append(c.alias(column.name))
        return part.select(*out)

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(aligned, parts))


def _rounded(part: DataFrame, names: Sequence[str]) -> list[str]:
    """Which bigint columns of a part have an integer that a double would round."""
    asked = [name for name in names if name in part.columns and isinstance(part.schema[name].dataType, T.LongType)]
    if not asked:
        return []
    tests = [F.bool_or(quoted(name).cast("double").try_cast("bigint").eqNullSafe(quoted(name)) == F.lit(False)) for name in asked]
    return [name for name, found in zip(asked, part.agg(*tests).first()) if found]


def _exact_double(c: Column, column: T.StructField) -> Column:
    if isinstance(column.dataType, T.DoubleType):
        return c
    wide = c.cast("double")
    rounded = F.raise_error(F.lit(f"column {column.name} has integers that its doubles would round"))
    return F.when(c.isNull() | (wide.try_cast("bigint") == c), wide).otherwise(rounded)

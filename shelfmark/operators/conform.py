"""Adjust a dataset to its contract.

The output schema depends on the data in two places: a double column whose
values are all whole becomes bigint, and a declared cast applies to a whole
column or not at all. ``profile`` answers both in one aggregation, and only for
the columns where the answer is open; ``conform`` is then a single projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import quoted, reject_case_clash
from ..contracts import TYPES, Contract
from ..functions.numbers import double_to_text, in_long_range, is_whole

# Text accepted as a number. Spark's own double parser also takes Java forms such
# as 1d and 0x1p3, which are not numbers for anyone else. Looking before casting
# pays: a failing cast costs a Java exception, some fifty times the look.
_NUMBER_TEXT = {
    T.LongType(): r"^\s*[+-]?\d+\s*$",
    T.DoubleType(): r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$",
}

_FLOATS = (T.DoubleType, T.FloatType)
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Profile:
    """Facts about one dataset: row count, whole-valued doubles, failing casts."""

    rows: int | None = None
    whole: dict[str, bool] = field(default_factory=dict)
    bad: dict[str, int] = field(default_factory=dict)


def can_cast(source: T.DataType, kind: str) -> bool:
    """Whether a cast to the contract type exists at all."""
    target = TYPES.get(kind)
    if target is None:
        return False
    if isinstance(target, T.StringType):
        return isinstance(source, T.AtomicType)
    if isinstance(source, (T.StringType, T.NullType)):
        return True
    if isinstance(target, (T.LongType, T.DoubleType)):
        return isinstance(source, (T.NumericType, T.BooleanType))
    return isinstance(source, _DATES)


def _has_fractions(source: T.DataType) -> bool:
    return isinstance(source, _FLOATS) or (isinstance(source, T.DecimalType) and source.scale > 0)


def cast_to(c: Column, source: T.DataType, kind: str, strict: bool = True) -> Column:
    """``c`` as the contract type. ``strict`` fails on a bad value, else null."""
    target = TYPES[kind]
    if source == target and kind != "timestamp":
        return c
    if isinstance(target, T.StringType) and _has_fractions(source):
        return double_to_text(c.cast("double"))
    out = c.cast(target) if strict else c.try_cast(target)
    if kind == "timestamp":
        out = F.date_trunc("millisecond", out).cast(target)
    return out


def _bad(c: Column, source: T.DataType, kind: str) -> Column | None:
    """Test for a value the cast cannot take; None when every value fits."""
    target = TYPES[kind]
    if isinstance(source, _FLOATS) and isinstance(target, T.LongType):
        return ~in_long_range(c)
    if isinstance(source, T.DecimalType) and isinstance(target, T.LongType):
        return c.try_cast("bigint").isNull()
    if isinstance(source, T.BinaryType):
        return ~F.is_valid_utf8(c.cast("string"))
    if not isinstance(source, T.StringType) or isinstance(target, T.StringType):
        return None
    failed = cast_to(c, source, kind, strict=False).isNull()
    return ~c.rlike(_NUMBER_TEXT[target]) | failed if target in _NUMBER_TEXT else failed


def checks(df: DataFrame, contract: Contract | None) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates still to be answered: whole-number tests and cast-failure counts."""
    whole: dict[str, Column] = {}
    bad: dict[str, Column] = {}
    if not contract:
        return whole, bad
    for column in df.schema.fields:
        c, kind = quoted(column.name), contract.type_of(column.name)
        is_double = isinstance(column.dataType, _FLOATS)
        # Declared float64 or int64 comes out the same with or without the test.
        if is_double and kind not in ("float64", "int64"):
            whole[column.name] = F.coalesce(F.bool_and(is_whole(c)), F.lit(True))
        if kind and can_cast(column.dataType, kind):
            test = _bad(c, column.dataType, kind)
            if test is not None:
                bad[column.name] = F.count_if(c.isNotNull() & test)
    return whole, bad


def profile(df: DataFrame, contract: Contract | None) -> Profile:
    """Run the open checks and the row count in one aggregation over ``df``."""
    whole, bad = checks(df, contract)
    return _facts(df.agg(F.count(F.lit(1)), *whole.values(), *bad.values()).first(), whole, bad)


def _facts(values: Sequence, whole: Iterable[str], bad: Iterable[str]) -> Profile:
    found = iter(values)
    return Profile(next(found), dict(zip(whole, found)), dict(zip(bad, found)))


def observed_profile(df: DataFrame, contract: Contract | None) -> tuple[DataFrame, Callable[[], Profile]]:
    """``df`` observed, and what returns its profile once all of it has been written.

    The facts come from the tasks that write, so they hold for exactly the rows
    that landed and cost no pass of their own.
    """
    whole, bad = checks(df, contract)
    seen = Observation()
    answers = [F.count(F.lit(1)), *whole.values(), *bad.values()]
    observed = df.observe(seen, *[answer.alias(f"fact{i}") for i, answer in enumerate(answers)])
    return observed, lambda: _facts([seen.get[f"fact{i}"] for i in range(len(answers))], whole, bad)


def profile_frame(df: DataFrame, contract: Contract) -> DataFrame:
    """The same facts as rows ``(column, whole, bad, rows)``."""
    whole, bad = checks(df, contract)
    no_whole, no_bad = F.lit(None).cast("boolean"), F.lit(None).cast("bigint")
    facts = [
        F.struct(
            F.lit(name).alias("column"),
            whole.get(name, no_whole).alias("whole"),
            bad.get(name, no_bad).alias("bad"),
        )
        for name in df.columns
        if name in whole or name in bad
    ]
    if not facts:
        facts = [F.struct(F.lit(None).cast("string").alias("column"), no_whole.alias("whole"), no_bad.alias("bad"))]
    summary = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*facts).alias("facts"))
    return summary.select(F.inline("facts"), "rows").filter("column is not null")


def _demoted(c: Column, name: str) -> Column:
    """A whole-valued double as bigint; a fraction the profile did not see is an error."""
    surprise = F.raise_error(F.lit(f"column {name} changed between profile and write"))
    return F.when(c.isNull() | is_whole(c), c.cast("bigint")).otherwise(surprise)


def conform(df: DataFrame, contract: Contract | None, facts: Profile) -> DataFrame:
    """Whole doubles to bigint, declared casts, then typed defaults.

    Columns without a contract pass through; so does a whole dataset without one.
    """
    if not contract:
        return df
    missing = contract.missing_from(df.columns)
    reject_case_clash(df.sparkSession, [*df.columns, *missing])
    out = []
    for column in df.schema.fields:
        c, dtype = quoted(column.name), column.dataType
        kind = contract.type_of(column.name)
        if facts.whole.get(column.name):
            c, dtype = _demoted(c, column.name), T.LongType()
        if kind and can_cast(dtype, kind) and not facts.bad.get(column.name):
            c = cast_to(c, dtype, kind)
        out.append(c.alias(column.name))
    return df.select(*out, *[default.alias(name) for name, default in missing.items()])


def kept_columns(df: DataFrame, contract: Contract | None, facts: Profile) -> dict[str, str]:
    """Declared columns that keep their source type, with the reason."""
    notes: dict[str, str] = {}
    for column in df.schema.fields if contract else ():
        kind = contract.type_of(column.name)
        if kind is None:
            continue
        if not can_cast(column.dataType, kind):
            notes[column.name] = f"{column.dataType.simpleString()} cannot become {kind}"
        elif facts.bad.get(column.name):
            notes[column.name] = f"{facts.bad[column.name]} values are no {kind}"
    return notes

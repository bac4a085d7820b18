"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfmark.session import scratch_path

#: An operator hands rows back once this many bytes have gathered, so that its
#: memory follows the longest text and not the number of rows in a batch.
FLUSH_BYTES = 8 << 20
#: Texts are looked at in groups of so many letters, or one by one if longer.
GROUP_LETTERS = 2 << 20


_turn: tuple[str, Callable[[], object]] | None = None


def take_turn(name: str, forget: Callable[[], object]) -> None:
    """Called by an operator in a worker before it remembers words. Workers serve many
    operators after each other, so what the one before remembered is let go."""
    global _turn
    if _turn is not None and _turn[0] != name:
        _turn[1]()
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what is freed
        if trim is not None:
            trim(0)
    _turn = name, forget


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and computes shared work once."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of the frame has, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(column: pa.Array) -> Iterator[str]:
    """Texts of an Arrow column one at a time; null is the empty text."""
    for value in column:
        yield value.as_py() or ""


def groups_of(column: pa.Array, letters: int = GROUP_LETTERS) -> Iterator[list[str]]:
    """Texts of an Arrow column in groups of about ``letters`` letters."""
    group, held = [], 0
    for text in texts_of(column):
        if group and held + len(text) > letters:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def map_texts(
    df: DataFrame,
    keys: list[str],
    text: str,
    outputs: str,
    row: Callable[[str], tuple] | None,
    width: Callable[[tuple], int] = lambda found: 64,
    rows_of: Callable[[list[str]], list[tuple]] | None = None,
) -> DataFrame:
    """``keys`` of each row with what ``row`` makes of its text.

    ``keys`` are names of columns, ``text`` may be one of them, and ``outputs`` is
    the DDL of the new columns. Runs as Arrow batches inside the
    tasks of the scan: no shuffle, and no more than one text, or one group of
    short ones, is held decoded. ``rows_of`` takes such groups in place of ``row``.
    """
    source = df.select(*dict.fromkeys([*keys, text]))  # a text among the keys travels once
    place = source.columns.index(text)
    schema = source.select(*keys).schema
    made = StructType.fromDDL(outputs)
    for field in made:
        schema = schema.add(field)
    names = [field.name for field in made]

    def results(column: pa.Array) -> Iterator[tuple]:
        if rows_of is None:
            yield from map(row, texts_of(column))
        else:
            for group in groups_of(column):
                yield from rows_of(group)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            start, held, rows = 0, 0, []
            for at, found in enumerate(results(batch.column(place))):
                rows.append(found)
                held += width(rows[-1])
                if held >= FLUSH_BYTES or at == batch.num_rows - 1:
                    if types is None:
                        types = [arrow_type(field.dataType.simpleString()) for field in made]
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
                    kept = [batch.column(k).slice(start, len(rows)) for k in range(len(keys))]
                    yield pa.RecordBatch.from_arrays(kept + columns, names=keys + names)
                    start, held, rows = at + 1, 0, []

    return source.mapInArrow(run, schema)


def arrow_type(name: str) -> pa.DataType:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    }
    if name.startswith("array<"):
        return pa.list_(arrow_type(name[6:-1]))
    return kinds[name]

"""Where dataset queries run: Spark's catalog or a JDBC database."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.documents import nested
from ..functions.numbers import int_or_default

DEFAULT_PORT = 3306

# How names are quoted, in standard SQL and in MySQL.
ANSI_QUOTE, MYSQL_QUOTE = '"', "`"

# MySQL behaviour the datasets rely on: TINYINT(1) stays a number, a zero date is
# null, and rows are streamed in fetch-size blocks instead of being buffered whole.
MYSQL_URL_OPTIONS = "useCursorFetch=true&tinyInt1isBit=false&zeroDateTimeBehavior=CONVERT_TO_NULL"


@dataclass(frozen=True)
class Split:
    """Parallel database read by ranges of a numeric, date or timestamp column.

    Without bounds the database is asked for the smallest and largest value.
    """

    column: str
    partitions: int
    lower: str | None = None
    upper: str | None = None


@dataclass(frozen=True)
class MonthSplit:
    """Parallel database read by months of a date or timestamp column.

    The database is asked once for the first and last day. Where the query lacks
    the column, or it is no date, one task reads the query.
    """

    column: str


@dataclass(frozen=True)
class QuantileSplit:
    """Parallel database read by ranges that hold about equally many rows.

    The database is asked once for the bounds: the smallest key of each of
    ``partitions`` equal shares of its sorted keys. So a key column that is dense in
    places, or no number at all, still gives even tasks; a key that holds a large
    share of the rows is a range of its own. ``sample`` is a condition in the
    database's SQL, such as ``MOD(CRC32(q.id), 100) = 0``, that spares it sorting
    every key. Without ``column`` the first whole-number column of the query is used.
    """

    partitions: int
    column: str | None = None
    sample: str | None = None


def identifier(column: str, quote: str) -> str:
    """A column of the query as SQL spells it, reserved words and blanks included."""
    return f"q.{quote}{column.replace(quote, 2 * quote)}{quote}"


def value_text(value: object) -> str:
    """A bound as SQL text."""
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    text = value.isoformat(" ") if isinstance(value, datetime) else str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[object], quote: str = ANSI_QUOTE) -> list[str]:
    """Conditions of which exactly one holds for every row: nulls, then ranges that
    begin at each bound. The first and the last range are open, as new keys may lie
    outside of what the bounds were taken from."""
    c = identifier(column, quote)
    starts = list(dict.fromkeys(bound for bound in bounds if bound is not None))[1:]
    nulls = f"{c} IS NULL"
    if not starts:
        return [nulls, f"{c} IS NOT NULL"]
    low = [f"{c} >= {value_text(bound)}" for bound in starts]
    high = [f"{c} < {value_text(bound)}" for bound in starts]
    return [nulls, high[0], *[f"{left} AND {right}" for left, right in zip(low, high[1:])], low[-1]]


def quantile_query(query: str, split: QuantileSplit, quote: str = ANSI_QUOTE) -> str:
    """The smallest key of each equal share of the sorted keys, in ascending order."""
    c = identifier(split.column, quote)
    wanted = f"{c} IS NOT NULL" + (f" AND ({split.sample})" if split.sample else "")
    shares = f"SELECT {c} AS k, NTILE({split.partitions}) OVER (ORDER BY {c}) AS share FROM {_subquery(query)} WHERE {wanted}"
    return f"SELECT MIN(s.k) AS bound FROM ({shares}) s GROUP BY s.share ORDER BY 1"


def month_predicates(column: str, first: date | None, last: date | None, quote: str = ANSI_QUOTE) -> list[str]:
    """Conditions of which exactly one holds for every row: nulls, then months.

    The first and last month are open, so a row that arrives outside the bounds
    while the query runs still has its place.
    """
    if first is None:
        return range_predicates(column, [], quote)
    return range_predicates(column, [first, *_month_starts(first, last)], quote)


def _month_starts(first: date, last: date) -> Iterator[date]:
    """First days of the months after the one of ``first``, up to that of ``last``."""
    for month in range(first.year * 12 + first.month, last.year * 12 + last.month):
        yield date(month // 12, month % 12 + 1, 1)


def query_text(query: str) -> str:
    return query.strip().rstrip(";").rstrip()


def _subquery(query: str) -> str:
    """The query in parentheses; on lines of its own, so it may end in a comment."""
    return f"(\n{query_text(query)}\n) q"


def bounds_query(query: str, column: str, quote: str = ANSI_QUOTE) -> str:
    c = identifier(column, quote)
    return f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {_subquery(query)}"


AnySplit = Split | MonthSplit | QuantileSplit


def first_whole_column(schema: T.StructType) -> str | None:
    """The first column of whole numbers, which is where queries put their keys."""
    for column in schema.fields:
        kind = column.dataType
        if isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0):
            return column.name
    return None


class CatalogSource:
    """Tables and views known to the Spark session."""

    def read(self, spark: SparkSession, query: str, split: AnySplit | None = None) -> DataFrame:
        return spark.sql(query_text(query))


@dataclass(frozen=True)
class JdbcSource:
    """A database. One task reads a query unless a split spreads it.

    A query is run once for its rows, and with a split whose bounds are open once
    more for the smallest and largest value of its column.
    """

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetch_size: int = 10_000
    quote: str = ANSI_QUOTE
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self, query: str, split: Split | None = None) -> dict[str, str]:
        options = {
            "url": self.url,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        for key in ("user", "password", "driver"):
            if getattr(self, key) is not None:
                options[key] = getattr(self, key)
        if split is None:
            options["query"] = query_text(query) + "\n"
        else:
            options |= {
                "dbtable": _subquery(query),
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return options | self.options

    def read(self, spark: SparkSession, query: str, split: AnySplit | None = None) -> DataFrame:
        if isinstance(split, MonthSplit):
            return self._by_month(spark, query, split.column)
        if isinstance(split, QuantileSplit):
            return self._by_quantiles(spark, query, split)
        if split is not None and split.lower is None:
            split = self._bounded(spark, query, split)
        return spark.read.format("jdbc").options(**self.reader_options(query, split)).load()

    def _by_month(self, spark: SparkSession, query: str, column: str) -> DataFrame:
        whole = self.read(spark, query)
        dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
        if column not in whole.columns or not isinstance(whole.schema[column].dataType, dates):
            return whole
        found = self.read(spark, bounds_query(query, column, self.quote))
        row = found.select(F.col("lo").cast("date"), F.col("hi").cast("date")).first()
        return self._by_predicates(spark, query, month_predicates(column, *row, self.quote))

    def _by_quantiles(self, spark: SparkSession, query: str, split: QuantileSplit) -> DataFrame:
        whole = self.read(spark, query)
        column = split.column or first_whole_column(whole.schema)
        if column is None or column not in whole.columns:
            return whole
        # At most ``partitions`` bounds reach the driver.
        bounds = [row.bound for row in self.read(spark, quantile_query(query, replace(split, column=column), self.quote)).collect()]
        return self._by_predicates(spark, query, range_predicates(column, bounds, self.quote))

    def _by_predicates(self, spark: SparkSession, query: str, predicates: list[str]) -> DataFrame:
        options = self.reader_options(query)
        options.pop("query")
        url = options.pop("url")
        return spark.read.jdbc(url, _subquery(query), predicates=predicates, properties=options)

    def _bounded(self, spark: SparkSession, query: str, split: Split) -> Split | None:
        row = self.read(spark, bounds_query(query, split.column, self.quote)).first()
        return None if row[0] is None else replace(split, lower=str(row[0]), upper=str(row[1]))


def connection_settings(
    tenants: DataFrame,
    host: str | None = None,
    port: object = DEFAULT_PORT,
    database: str | None = None,
    user: str | None = None,
    password: str | None = None,
) -> DataFrame:
    """Connection fields of each tenant document, field by field over the defaults."""

    def setting(key: str, default: str | None) -> Column:
        return nested(F.col("parametrizacaoIntegracao"), "conexaoBanco", key, default=default)

    fallback = int_or_default(F.lit(None if port is None else str(port)), DEFAULT_PORT)
    return tenants.select(
        setting("host", host).alias("host"),
        F.coalesce(int_or_default(setting("porta", None), None), fallback).alias("port"),
        setting("nomeOuCaminhoBanco", database).alias("database"),
        setting("usuario", user).alias("user"),
        setting("senha", password).alias("password"),
    )


def mysql_source(host: str, port: int, database: str, user: str | None, password: str | None) -> JdbcSource:
    url = f"jdbc:mysql://{host}:{port}/{database}?{MYSQL_URL_OPTIONS}"
    return JdbcSource(url, user, password, quote=MYSQL_QUOTE)

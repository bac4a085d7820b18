"""One dataset: from query to conformed, write-ready rows."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Protocol, TypeVar

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import MONTH, YEAR
from ..contracts import Contract
from ..operators.conform import Profile, can_cast, checks, conform, kept_columns, observed_profile, profile
from ..operators.derive import cluster_by_month, normalize, with_audit, with_partition_keys
from ..operators.sink import cluster_for_write, partition_cols
from ..session import scratch_path
from ..sources.queries import AnySplit, CatalogSource, JdbcSource
from ..storage import delete_tree
from ..unions import union_parts

# Datasets kept by month, with the column that dates their rows.
DATE_COLUMNS = {"Vendas": "DataVenda", "Compras": "DataEmissaoNF"}

# Fixed value: into so many groups of months large landed rows are dealt, one shuffle each.
MONTH_GROUPS = 8

# Fixed value: landed rows are read by this run alone and gone after it.
STAGED_OPTIONS = {"compression": "zstd"}

# JVM errors that mean the connection failed, not the query.
CONNECTION_ERRORS = (
    "SQLTransientConnectionException",
    "SQLNonTransientConnectionException",
    "SQLRecoverableException",
    "CommunicationsException",
    "java.net.ConnectException",
    "java.net.SocketException",
    "java.net.SocketTimeoutException",
)

Result = TypeVar("Result")


class Source(Protocol):
    def read(self, spark: SparkSession, query: str, split: AnySplit | None = None) -> DataFrame: ...


@dataclass(frozen=True)
class DatasetSpec:
    """A named query. Specs whose names agree without spaces feed one dataset."""

    name: str
    query: str
    date_col: str | None = None
    time_cols: Sequence[str] = ("HoraVenda",)
    timestamps_too: bool = True
    key_mode: str = "positional"
    date_format: str | None = None
    split: AnySplit | None = None

    @property
    def dataset(self) -> str:
        return self.name.replace(" ", "")

    @property
    def date_column(self) -> str | None:
        return self.date_col or DATE_COLUMNS.get(self.dataset)


@dataclass
class Prepared:
    """A conformed dataset ready to be written, and what it leaves behind.

    ``parts`` are the landed rows of each query with what was learnt of them, from
    which the frame can be made again.
    """

    frame: DataFrame
    cols: list[str]
    rows: int | None
    notes: dict[str, str] = field(default_factory=dict)
    staged: list[str] = field(default_factory=list)
    parts: list[Landed] = field(default_factory=list)


@dataclass(frozen=True)
class Landed:
    """Rows of one query in the shared folder, and their profile."""

    path: str
    schema: str
    facts: Profile

    def read(self, spark: SparkSession, contract: Contract | None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        return conform(spark.read.schema(schema).parquet(self.path), contract, self.facts)


def is_connection_error(error: BaseException) -> bool:
    if isinstance(error, (AnalysisException, ParseException)):
        return False
    return isinstance(error, ConnectionError) or any(name in str(error) for name in CONNECTION_ERRORS)


def with_retry(action: Callable[[], Result], attempts: int = 5, delay: float = 5.0) -> Result:
    """Run ``action``, again after ``delay`` seconds when the connection failed."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if attempt == attempts or not is_connection_error(error):
                raise
            time.sleep(delay)
    raise ValueError("attempts must be at least 1")


def prepare(
    df: DataFrame,
    spec: DatasetSpec,
    tenant: str,
    as_of: datetime | None = None,
    contract: Contract | None = None,
) -> DataFrame:
    """Everything before the cast to the contract: plain types, audit columns, partition keys."""
    kinds = contract.columns if contract else {}
    exact = {name for name, kind in kinds.items() if kind in ("string", "int64")}
    audited = with_audit(normalize(df, spec.time_cols, spec.timestamps_too, exact), tenant, as_of)
    return with_partition_keys(audited, spec.date_column, spec.key_mode, spec.date_format)


def conform_dataset(df: DataFrame, contract: Contract | None) -> DataFrame:
    """Profile, when the contract leaves anything open, and conform."""
    whole, bad = checks(df, contract)
    facts = profile(df, contract) if whole or bad else Profile()
    return conform(df, contract, facts)


def is_repeatable(df: DataFrame) -> bool:
    """Whether Spark holds the query to give the same rows each time it runs."""
    return df._jdf.queryExecution().analyzed().deterministic()


def fills_cores(df: DataFrame) -> bool:
    """Whether the files that ``df`` reads are enough for a task on every core.

    Spark cuts files no finer than its cost of opening one. Where it does not know
    a size, as with databases and rows made in the driver, the answer is no.
    """
    execution = df._jdf.queryExecution()
    conf = execution.sparkSession().sessionState().conf()
    leaves = execution.optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return df.sparkSession.sparkContext.defaultParallelism * conf.filesOpenCostInBytes() <= size < conf.defaultSizeInBytes()


def stage(df: DataFrame, path: str) -> DataFrame:
    """Land rows as flat Parquet in the shared scratch folder and read them back.

    The source is read once, and every destination then sees the same rows.
    """
    df.write.mode("overwrite").options(**STAGED_OPTIONS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by_month(landed: DataFrame, path: str) -> DataFrame:
    """Land rows again, those of a month together, some months at a time.

    The shuffle files on disk are those of one group of months, and none of the
    query's own are left by then.
    """
    group = F.pmod(F.hash(YEAR, MONTH), F.lit(MONTH_GROUPS))
    for i in range(MONTH_GROUPS):
        months = cluster_for_write(landed.filter(group == i), [YEAR, MONTH])
        months.write.mode("append").options(**STAGED_OPTIONS).parquet(path)
    return landed.sparkSession.read.schema(landed.schema).parquet(path)


def stay_double(facts: Profile, df: DataFrame, contract: Contract | None, delivered: Mapping[str, T.DataType]) -> Profile:
    """``facts`` under which no column that was delivered as double turns bigint."""
    kinds = contract.columns if contract else {}
    kept = {
        f.name: False
        for f in df.schema.fields
        if facts.whole.get(f.name)
        and isinstance(delivered.get(f.name), T.DoubleType)
        and not can_cast(f.dataType, kinds.get(f.name, ""))
    }
    return replace(facts, whole=facts.whole | kept)


def type_changes(df: DataFrame, delivered: Mapping[str, T.DataType]) -> list[str]:
    """Columns of ``df`` whose type is not the one delivered before."""
    return [
        f"{f.name} from {delivered[f.name].simpleString()} to {f.dataType.simpleString()}"
        for f in df.schema.fields
        if f.name in delivered and delivered[f.name].simpleString() != f.dataType.simpleString()
    ]


def build_dataset(
    spark: SparkSession,
    specs: Sequence[DatasetSpec],
    source: Source,
    contract: Contract | None,
    tenant: str,
    as_of: datetime | None = None,
    copies: int = 1,
    attempts: int = 5,
    delay: float = 5.0,
    staging: str = "always",
    delivered: Mapping[str, T.DataType] | None = None,
    take_turn: Callable[[], object] = lambda: None,
) -> Prepared:
    """Extract and conform the queries of one dataset.

    Each query runs once, inside the retry: its rows land in the shared scratch
    folder, and the profile is observed by the tasks that land them. Roots then
    read the landed rows. Where the files of a dated query fill all cores, its rows
    land as they come and are brought together by month after that.

    ``staging="auto"`` spares the landing where a single catalog query that Spark
    holds to be deterministic goes to one root: the profile then runs the query
    for the few columns it needs and the write runs it in full. That is for plain
    scans; a query that means something else each time (``current_timestamp()``,
    ``LIMIT`` without order) may then be profiled on other rows than are written.
    ``rows`` is None in that case, and is counted by the write.

    ``delivered`` are the column types at the destination: what is double there
    stays double, even when this load happens to be whole. ``take_turn`` is called
    before a query runs whose files fill all cores; it may wait there.
    """
    if staging not in ("auto", "always"):
        raise ValueError(f"unknown staging {staging!r}")
    delivered = delivered or {}
    read_once = (
        staging == "always" or copies > 1 or len(specs) > 1 or not isinstance(source, CatalogSource)
    )
    staged: list[str] = []
    landed: list[Landed] = []
    parts: list[DataFrame] = []
    layouts: set[tuple[str, ...]] = set()
    notes: dict[str, str] = {}
    rows: int | None = 0

    def ready(found: DataFrame, spec: DatasetSpec) -> DataFrame:
        return prepare(found, spec, tenant, as_of, contract)

    def clustered(found: DataFrame, spec: DatasetSpec) -> DataFrame:
        return cluster_by_month(found, spec.date_column, spec.key_mode, spec.date_format)

    def land(spec: DatasetSpec) -> tuple[DataFrame, Profile, str | None]:
        found = source.read(spark, spec.query, spec.split)
        cols = partition_cols(spec.date_column, found.columns)
        layouts.add(tuple(cols))
        large = fills_cores(found)
        if large:
            take_turn()
        if read_once or not is_repeatable(found):
            path = scratch_path(spark, "stage")
            staged.append(path)
            if not (large and len(cols) > 1):
                observed, facts = observed_profile(ready(clustered(found, spec), spec), contract)
                return stage(observed, path), facts(), path
            as_it_comes = scratch_path(spark, "stage")
            staged.append(as_it_comes)
            observed, facts = observed_profile(ready(found, spec), contract)
            frame = stage_by_month(stage(observed, as_it_comes), path)
            delete_tree(spark, as_it_comes)
            return frame, facts(), path
        unclustered = ready(found, spec)
        facts = profile(unclustered, contract) if any(checks(unclustered, contract)) else Profile()
        return ready(clustered(found, spec), spec), replace(facts, rows=None), None

    try:
        for spec in specs:
            frame, facts, path = with_retry(lambda: land(spec), attempts, delay)
            rows = None if rows is None or facts.rows is None else rows + facts.rows
            facts = stay_double(facts, frame, contract, delivered)
            if path is not None:
                landed.append(Landed(path, frame.schema.json(), facts))
            notes |= kept_columns(frame, contract, facts)
            if isinstance(source, JdbcSource) and spec.split is None:
                notes["(query)"] = "read by a single task; name a split"
            parts.append(conform(frame, contract, facts))
        if len(layouts) > 1:
            raise ValueError(f"queries of {specs[0].dataset} disagree on the date column")
    except BaseException:
        discard(spark, staged)
        raise
    frame = parts[0] if len(parts) == 1 else union_parts(parts)
    return Prepared(frame, list(layouts.pop()), rows, notes, staged, landed)


def discard(spark: SparkSession, staged: Sequence[str]) -> None:
    for path in staged:
        delete_tree(spark, path)

"""Full runs: datasets side by side, delivery to every root, gate, refresh table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import replace
from datetime import datetime, timezone
from threading import RLock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..columns import TENANT
from ..contracts import Contract, bundled_contracts
from ..operators.partitions import escape_value
from ..operators.sink import overwrite_partitions
from ..session import RUN_CONF, keep_scratch, session_conf
from ..sources.clouds import apply_hadoop_conf, destinations, read_clouds
from ..sources.listing import delivered_types
from ..sources.queries import AnySplit, CatalogSource, MonthSplit, connection_settings, mysql_source
from ..sources.registry import (
    DEFAULT_WORKERS,
    RegistryError,
    dataset_queries,
    read_tenants,
    select_dataset,
    tenant_document,
    workers as workers_setting,
)
from .dataset import DatasetSpec, Prepared, Source, build_dataset, discard, type_changes
from .ledger import announce, complete, ledger_types
from .report import (
    EMPTY,
    FAILED,
    MIN_DATASETS,
    REPORT_SCHEMA,
    SKIPPED,
    WRITTEN,
    gate_status,
    publish_gate,
    refresh_rows,
)

REFRESH_TABLE = "Atualizacao"


class TypeChange(ValueError):
    """A column comes with another type than the months delivered before."""


Item = TypeVar("Item")
Result = TypeVar("Result")


def fan_out(
    df: DataFrame,
    roots: Sequence[str],
    cols: Sequence[str],
    on_layout_change: str = "error",
    tenant: str | None = None,
) -> dict[str, str | None]:
    """Write ``df`` to every root at once; the error text, or None, per root.

    One root failing does not stop the others. ``df`` is read once per root, so
    hand over staged rows when the source may change in between.
    """

    def deliver(root: str) -> str | None:
        try:
            overwrite_partitions(df, root, cols, on_layout_change=on_layout_change, tenant=tenant)
        except Exception as error:
            return _text(error)
        return None

    if len(roots) == 1:
        return {roots[0]: deliver(roots[0])}
    return dict(zip(roots, in_threads(df.sparkSession, deliver, roots, len(roots))))


def in_threads(spark: SparkSession, task: Callable[[Item], Result], items: Iterable[Item], size: int) -> list[Result]:
    """Run driver-side tasks side by side, each with its own Spark job properties."""
    with ThreadPoolExecutor(size) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(task), item) for item in items]
        return [future.result() for future in futures]


def _text(error: BaseException) -> str:
    """The whole text, as the cause of a failed job stands far below its first line."""
    return f"{type(error).__name__}: {str(error).strip()}"


def group_specs(specs: Sequence[DatasetSpec]) -> dict[str, list[DatasetSpec]]:
    """Specs by dataset, in order of first appearance."""
    groups: dict[str, list[DatasetSpec]] = {}
    for spec in specs:
        groups.setdefault(spec.dataset, []).append(spec)
    return groups


def extract(
    spark: SparkSession,
    specs: Sequence[DatasetSpec],
    source: Source | None = None,
    workers: int = DEFAULT_WORKERS,
) -> tuple[dict[str, list[DataFrame]], dict[str, str]]:
    """Open a batch of queries side by side: lazy results and errors, per dataset.

    A query that cannot be opened leaves an error and does not stop the others.
    """
    source = source or CatalogSource()

    def one(spec: DatasetSpec) -> DataFrame | str:
        try:
            return source.read(spark, spec.query, spec.split)
        except Exception as error:
            return _text(error)

    frames: dict[str, list[DataFrame]] = {}
    errors: dict[str, str] = {}
    for spec, found in zip(specs, in_threads(spark, one, specs, max(1, workers))):
        if isinstance(found, str):
            errors[spec.dataset] = found
        else:
            frames.setdefault(spec.dataset, []).append(found)
    return frames, errors


def row_counts(batch: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """``(dataset, rows)`` of an extracted batch, counted in one job."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(dataset).alias("dataset"), "rows")
        for dataset, frames in batch.items()
        for frame in frames
    ]
    union = counted[0]
    for frame in counted[1:]:
        union = union.union(frame)
    return union.groupBy("dataset").agg(F.sum("rows").alias("rows"))


def _deliver(prepared: Prepared, paths: Sequence[str], tenant: str, on_layout_change: str) -> tuple[int, dict]:
    if prepared.rows is not None:
        if prepared.rows == 0:
            return 0, {}
        return prepared.rows, fan_out(prepared.frame, paths, prepared.cols, on_layout_change, tenant)
    # Counted in the tasks that write, after the last shuffle, so a task that is
    # run again on another executor is not counted twice.
    seen = Observation()
    counted = prepared.frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    errors = fan_out(counted, paths, prepared.cols, on_layout_change, tenant)
    return (0 if any(errors.values()) else seen.get.get("rows", 0)), errors


def _deliver_by_ledger(
    prepared: Prepared, paths: Sequence[str], tenant: str, on_layout_change: str
) -> tuple[int, dict, list[str]]:
    """Rows, errors by path, and the landed folders that some path still needs."""
    spark = prepared.frame.sparkSession
    intents = {intent.path: intent for intent in announce(spark, prepared, paths, tenant, on_layout_change)}
    landed = [part.path for part in prepared.parts]
    for path in landed:  # whatever happens from here on, they can be delivered
        keep_scratch(path)
    errors = fan_out(prepared.frame, paths, prepared.cols, on_layout_change, tenant)
    for path, text in errors.items():
        if text is None:
            complete(spark, intents[path])
    return prepared.rows, errors, landed if any(errors.values()) else []


def _plans(prepared: Prepared, paths: Sequence[str], tenant: str) -> list[tuple]:
    """Replacement plans of one tenant's load: a row for each month of the tenant."""
    if prepared.rows == 0:
        return []
    found = []
    for path in paths:
        plan = overwrite_partitions(prepared.frame, path, prepared.cols, dry_run=True, tenant=tenant)
        found += [(path, *row) for row in plan.collect()]
    return found


PLAN_SCHEMA = "root string, tenant string, path string, action string, whole_tenant boolean"


def run(
    spark: SparkSession,
    specs: Sequence[DatasetSpec],
    tenant: str,
    roots: Sequence[str],
    contracts: Mapping[str, Contract] | None = None,
    source: Source | None = None,
    as_of: datetime | None = None,
    workers: int = DEFAULT_WORKERS,
    min_datasets: int = MIN_DATASETS,
    gate: str = "configured",
    attempts: int = 5,
    delay: float = 5.0,
    on_layout_change: str = "error",
    staging: str = "always",
    on_type_change: str = "error",
    ledger: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Extract, conform and deliver every dataset, then maybe the refresh table.

    ``roots`` are the portal folders; a dataset lands in ``root/dataset``. The
    report has a row per dataset and a last one for the refresh table, which is
    skipped unless the gate opens. ``as_of`` fixes the clock.

    A dataset kept by month must keep its column types, or its months cannot be
    read together. A column delivered as double stays one; any other change of
    type is an error, unless ``on_type_change="allow"`` lets every load choose
    its types by its own values.

    ``ledger`` keeps account of deliveries in the dataset folders. What could not be
    delivered to a root is then owed to it: its landed rows stay, and ``resume``
    delivers them later to the roots that lack them.

    ``dry_run`` delivers nothing and gives the replacement plan of every dataset
    and root instead of the report.

    Datasets whose files fill all cores take turns, from query to last root, as
    company would not speed them up but put its shuffle files and landed rows
    beside theirs. The others run beside them.
    """
    if on_type_change not in ("error", "allow"):
        raise ValueError(f"unknown on_type_change {on_type_change!r}")
    if not specs:
        raise ValueError("no queries configured")
    if not roots:
        raise ValueError("no destination roots")
    started = as_of or datetime.now(timezone.utc)
    contracts = bundled_contracts() if contracts is None else contracts
    source = source or CatalogSource()
    large = RLock()

    def one(item: tuple[str, list[DatasetSpec]]) -> tuple:
        with ExitStack() as turn:
            return deliver(*item, lambda: turn.enter_context(large))

    def deliver(dataset: str, group: list[DatasetSpec], take_turn: Callable[[], object]) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", dataset)
        clock = time.monotonic()
        rows, delivered, error, notes = None, None, None, {}
        status = FAILED
        try:
            if not dataset:
                raise ValueError("query without a name")
            paths = [f"{root.rstrip('/')}/{dataset}" for root in roots]
            before = {}
            if on_type_change == "error":
                for path in reversed(paths):
                    entered = ledger_types(spark, path, tenant) if ledger else None
                    in_folders = f"{path}/{TENANT}={escape_value(tenant)}"
                    before |= delivered_types(spark, in_folders) if entered is None else entered
            prepared = build_dataset(
                spark, group, source, contracts.get(dataset), tenant, as_of, len(roots), attempts, delay,
                "always" if ledger else staging, before, take_turn,
            )
            owed: list[str] = []
            try:
                notes = prepared.notes
                changed = type_changes(prepared.frame, before) if len(prepared.cols) > 1 else []
                if changed and prepared.rows != 0 and not prepared.frame.isEmpty():
                    raise TypeChange("; ".join(changed))
                if dry_run:
                    return dataset, _plans(prepared, paths, tenant)
                if ledger and prepared.rows:
                    owed = [part.path for part in prepared.parts]
                    rows, errors, owed = _deliver_by_ledger(prepared, paths, tenant, on_layout_change)
                else:
                    rows, errors = _deliver(prepared, paths, tenant, on_layout_change)
            finally:
                discard(spark, [path for path in prepared.staged if path not in owed])
            failures = [f"{path}: {text}" for path, text in errors.items() if text]
            if failures:
                delivered, error = False, "; ".join(failures)
            elif rows == 0:
                status = EMPTY
            else:
                delivered, status = True, WRITTEN
        except Exception as failure:
            error = _text(failure)
        noted = "; ".join(f"{name}: {text}" for name, text in notes.items()) or None
        return dataset, status, rows, delivered, error, noted, time.monotonic() - clock

    if dry_run:
        with session_conf(spark, RUN_CONF):
            found = in_threads(spark, one, group_specs(specs).items(), max(1, workers))
        failed = [row for row in found if len(row) > 2]
        if failed:
            raise RuntimeError("; ".join(f"{row[0]}: {row[4]}" for row in failed))
        return spark.createDataFrame([row for _, plans in found for row in plans], PLAN_SCHEMA)
    with session_conf(spark, RUN_CONF):
        rows = in_threads(spark, one, group_specs(specs).items(), max(1, workers))
        report = spark.createDataFrame(rows, REPORT_SCHEMA)
        opens = publish_gate(gate_status(report, gate), min_datasets).first().publish
        rows.append(_refresh(spark, tenant, roots, contracts, started) if opens else
                    (REFRESH_TABLE, SKIPPED, None, None, None, None, 0.0))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _refresh(
    spark: SparkSession,
    tenant: str,
    roots: Sequence[str],
    contracts: Mapping[str, Contract],
    started: datetime,
) -> tuple:
    clock = time.monotonic()
    if started.tzinfo is not None:
        started = started.astimezone(timezone.utc).replace(tzinfo=None)
    moment = F.lit(started.isoformat(" ")).cast("timestamp_ntz")
    one_row = spark.range(1).select(F.lit(tenant).alias("tenant"), moment.alias("refreshed_at"))
    table = refresh_rows(one_row, contracts.get(REFRESH_TABLE))
    errors = fan_out(table, [f"{root.rstrip('/')}/{REFRESH_TABLE}" for root in roots], [TENANT], tenant=tenant)
    failures = [f"{path}: {text}" for path, text in errors.items() if text]
    status = FAILED if failures else WRITTEN
    return REFRESH_TABLE, status, 1, not failures, "; ".join(failures) or None, None, time.monotonic() - clock


def run_from_documents(
    spark: SparkSession,
    tenant: str,
    tenants_path: str,
    clouds_path: str,
    dataset: str | None = None,
    source: Source | None = None,
    default_portal: str | None = None,
    defaults: Mapping[str, object] | None = None,
    splits: Mapping[str, AnySplit] | None = None,
    **options: object,
) -> DataFrame:
    """A run configured by the tenant and cloud documents.

    ``dataset`` limits the run to one query name; an unknown name runs them all.
    ``defaults`` are connection fields the tenant document may leave out;
    ``source`` replaces the configured database; ``splits`` names, per dataset,
    the column by which the database is read in parallel. Datasets with a date
    column are read by month without being named.
    """
    document = tenant_document(read_tenants(spark, tenants_path), tenant)
    queries = dataset_queries(document)
    if queries.isEmpty():
        raise RegistryError(f"tenant {tenant!r} has no queries")
    targets = destinations(document, read_clouds(spark, clouds_path), default_portal)
    apply_hadoop_conf(spark, targets)
    if source is None:
        source = mysql_source(**connection_settings(document, **(defaults or {})).first().asDict())
    options.setdefault("workers", document.select(workers_setting()).first()[0])
    chosen = select_dataset(queries, dataset).select("name", "query").collect()
    plain = [DatasetSpec(row["name"] or "", row["query"] or "") for row in chosen]

    def split(spec: DatasetSpec) -> AnySplit | None:
        by_month = MonthSplit(spec.date_column) if spec.date_column else None
        return (splits or {}).get(spec.dataset, by_month)

    specs = [replace(spec, split=split(spec)) for spec in plain]
    return run(spark, specs, tenant, [target.root for target in targets], source=source, **options)

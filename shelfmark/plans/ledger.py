"""What has been delivered to a destination, and what is still owed to it.

Each dataset folder has a ``_ledger`` that readers of the dataset do not see. Before
partitions are replaced, an intent is written there: which partitions, and where the
landed rows are. When they have been replaced, their rows, files and column types are
read from the footers of what lies there now and appended as a folder of Parquet named
by the run; then the intent goes. An intent without such a folder is a delivery that
failed or whose driver died. As a replacement gives the same partitions however often
it is done, :func:`resume` does it again from the landed rows.

State, types and emptiness of a destination come from the ledger without a look at
its folders; :func:`reconcile` holds one against the other, and :func:`rebuild_ledger`
makes the ledger anew from the folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import TENANT
from ..contracts import Contract, bundled_contracts
from ..functions.text import first_segment
from ..operators.conform import Profile
from ..operators.partitions import escape_value, reloaded_partitions
from ..operators.sink import overwrite_partitions
from ..sources.footers import FIELDS, column_history, footers, partition_totals
from ..sources.listing import joined_types
from ..storage import delete_tree, glob_paths, literal, path_exists, read_text, write_text
from ..unions import union_parts
from .dataset import Landed, Prepared

LEDGER = "_ledger"
ENTRIES = f"path string, files bigint, rows bigint, bytes bigint, fields {FIELDS}, delivered_at timestamp_ntz"


@dataclass(frozen=True)
class Intent:
    """A replacement that has been announced. ``path`` is the dataset's folder."""

    run: str
    path: str
    tenant: str
    cols: list[str]
    partitions: list[str]
    parts: list[Landed]
    on_layout_change: str = "error"

    @property
    def mark(self) -> str:
        return f"{self.path}/{LEDGER}/{self.run}.intent"

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> Intent:
        found = json.loads(text)
        parts = [Landed(p["path"], p["schema"], Profile(**p["facts"])) for p in found.pop("parts")]
        return Intent(parts=parts, **found)

    def frame(self, spark: SparkSession, contract: Contract | None) -> DataFrame:
        """The conformed rows, made again from what has landed."""
        read = [part.read(spark, contract) for part in self.parts]
        return read[0] if len(read) == 1 else union_parts(read)


def announce(spark: SparkSession, prepared: Prepared, paths: Sequence[str], tenant: str, on_layout_change: str = "error") -> list[Intent]:
    """Intents of one run, one in each dataset folder of ``paths``.

    Partitions of one tenant's load are named one by one: its months.
    """
    run = uuid.uuid4().hex
    months = [row.path for row in reloaded_partitions(prepared.frame, prepared.cols).select("path").collect()]
    intents = [Intent(run, path, tenant, list(prepared.cols), sorted(months), prepared.parts, on_layout_change) for path in paths]
    for intent in intents:
        write_text(spark, intent.mark, intent.text())
    return intents


def complete(spark: SparkSession, intent: Intent) -> None:
    """Enter what now lies in the intended partitions, and take the intent away."""
    found = footers(spark, f"{intent.path}/{TENANT}={escape_value(intent.tenant)}")
    _append(spark, intent.path, intent.run, found.filter(F.col("path").isin(intent.partitions)))
    delete_tree(spark, intent.mark)


def _append(spark: SparkSession, path: str, run: str, found: DataFrame) -> None:
    moment = F.lit(datetime.now(timezone.utc).replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    # All files of a partition come from one load and have the same columns.
    entries = found.groupBy("path").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
        F.min_by("fields", "file").alias("fields"),
    )
    entries.withColumn("delivered_at", moment).write.mode("overwrite").parquet(f"{path}/{LEDGER}/run={run}")


def ledger_entries(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of a dataset's ledger, with its ``run``."""
    kept = T.StructType.fromDDL(ENTRIES).add("run", T.StringType())
    runs = glob_paths(spark, f"{literal(path)}/{LEDGER}/run=*/_SUCCESS")
    if not runs:
        return spark.createDataFrame([], kept)
    return spark.read.schema(kept).option("basePath", f"{path}/{LEDGER}").parquet(*[literal(run.rpartition("/")[0]) for run in runs])


def ledger_state(entries: DataFrame) -> DataFrame:
    """``(path, tenant, files, rows, bytes, fields, run)``: the last entry of each partition.

    A reload of the bare tenant drops the months that the tenant had before.
    """
    names = ["files", "rows", "bytes", "fields", "run"]
    order = F.struct("delivered_at", "run")
    last = entries.groupBy("path").agg(F.max("delivered_at").alias("at"), F.max_by(F.struct(*names), order).alias("entry"))
    last = last.withColumn("tenant", first_segment(F.col("path")))
    whole = last.filter("path = tenant").select("tenant", F.col("at").alias("whole_at"))
    kept = last.join(whole, "tenant", "left").filter("path = tenant or whole_at is null or at > whole_at")
    return kept.select("path", "tenant", *[f"entry.{name}" for name in names])


def ledger_types(spark: SparkSession, path: str, tenant: str) -> dict[str, T.DataType] | None:
    """Column types over all months that the ledger has of a tenant; None without entries."""
    folder = f"{TENANT}={escape_value(tenant)}"
    state = ledger_state(ledger_entries(spark, path)).filter(F.col("tenant") == folder)
    history = column_history(state.filter(F.col("path") != F.col("tenant"))).collect()
    if not history and state.isEmpty():
        return None
    return {row.name: joined_types(row.types) for row in history}


def rebuild_ledger(spark: SparkSession, path: str) -> str:
    """Enter what lies in the dataset's folders as if it were delivered now; the run's name.

    Needed once for a destination that was filled without a ledger, or whose files
    were changed by others.
    """
    run = f"rebuilt-{uuid.uuid4().hex}"
    before = glob_paths(spark, f"{literal(path)}/{LEDGER}/run=*")
    _append(spark, path, run, footers(spark, path))
    for folder in before:  # what they say is told by the folders, or no longer true
        delete_tree(spark, folder)
    return run


def reconcile(spark: SparkSession, path: str) -> DataFrame:
    """``(path, rows_entered, rows_found, files_entered, files_found, verdict)``.

    ``agrees``, ``differs`` in rows or files, ``missing`` from the folders, or
    ``unentered``. Counts found are those of the footers of all files.
    """
    entered = ledger_state(ledger_entries(spark, path)).select(
        "path", F.col("rows").alias("rows_entered"), F.col("files").alias("files_entered")
    )
    found = partition_totals(footers(spark, path)).select(
        "path", F.col("rows").alias("rows_found"), F.col("files").alias("files_found")
    )
    same = (F.col("rows_entered") == F.col("rows_found")) & (F.col("files_entered") == F.col("files_found"))
    verdict = (
        F.when(F.col("rows_found").isNull(), "missing")
        .when(F.col("rows_entered").isNull(), "unentered")
        .when(same, "agrees")
        .otherwise("differs")
    )
    both = entered.join(found, "path", "full")
    return both.select("path", "rows_entered", "rows_found", "files_entered", "files_found", verdict.alias("verdict"))


def open_intents(spark: SparkSession, roots: Sequence[str]) -> list[Intent]:
    """Deliveries below portal folders that were announced and not completed."""
    found = []
    for root in roots:
        for mark in glob_paths(spark, f"{literal(root.rstrip('/'))}/*/{LEDGER}/*.intent"):
            intent = Intent.of(read_text(spark, mark))
            if path_exists(spark, f"{intent.path}/{LEDGER}/run={intent.run}/_SUCCESS"):
                delete_tree(spark, mark)  # died between the entry and here
            else:
                found.append(intent)
    return found


RESUMED = "path string, run string, rows bigint, delivered boolean, error string"


def resume(
    spark: SparkSession, roots: Sequence[str], contracts: Mapping[str, Contract] | None = None, sweep: bool = False
) -> DataFrame:
    """Deliver what is owed to ``roots``, from landed rows; a row for each intent.

    Only the roots that lack a delivery are written. Landed rows go when no root
    needs them any more. Call it with all roots of a run, and while no run is at
    work on them. ``sweep`` also removes what Spark staged in the dataset folders
    for a write that never ended; nobody else may be writing there then.
    """
    contracts = bundled_contracts() if contracts is None else contracts
    intents = open_intents(spark, roots)
    done, rows = [], []
    for intent in intents:
        error, count = None, None
        try:
            absent = [part.path for part in intent.parts if not path_exists(spark, part.path)]
            if absent:
                raise FileNotFoundError(f"landed rows are gone: {', '.join(absent)}")
            if sweep:
                for staged in glob_paths(spark, f"{literal(intent.path)}/.spark-staging-*"):
                    delete_tree(spark, staged)
            frame = intent.frame(spark, contracts.get(intent.path.rpartition("/")[2]))
            overwrite_partitions(frame, intent.path, intent.cols, on_layout_change=intent.on_layout_change, tenant=intent.tenant)
            complete(spark, intent)
            count = sum(part.facts.rows or 0 for part in intent.parts)
            done.append(intent)
        except Exception as failure:
            error = f"{type(failure).__name__}: {str(failure).strip()}"
        rows.append((intent.path, intent.run, count, error is None, error))
    owed = {part.path for intent in intents if intent not in done for part in intent.parts}
    for path in {part.path for intent in done for part in intent.parts} - owed:
        delete_tree(spark, path)
    return spark.createDataFrame(rows, RESUMED)

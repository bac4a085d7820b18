"""Run report, its summary, and the gate in front of the refresh table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import REFRESHED_AT, TENANT, TENANT_COPY
from ..contracts import Contract
from ..functions.clock import refresh_text
from ..operators.conform import Profile, conform

WRITTEN, EMPTY, FAILED, SKIPPED = "written", "empty", "failed", "skipped"

# One row per dataset. ``delivered`` is null when a dataset never reached a
# destination: it was empty or its extraction failed.
REPORT_SCHEMA = """
    dataset string, status string, rows bigint, delivered boolean,
    error string, notes string, seconds double
"""

# Fixed value: the refresh table is published for this many datasets or more.
MIN_DATASETS = 8


def written(report: DataFrame) -> DataFrame:
    """Datasets that produced output and reached every destination."""
    return report.filter(F.col("status") == WRITTEN)


def run_summary(report: DataFrame) -> DataFrame:
    """How many datasets succeeded and failed, overall and at delivery."""
    return report.agg(
        F.count_if(F.col("status") == WRITTEN).alias("succeeded"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_if(F.col("status") == EMPTY).alias("empty"),
        F.count_if(F.col("delivered") == F.lit(False)).alias("failed_delivery"),
    )


def gate_status(report: DataFrame, gate: str = "configured") -> DataFrame:
    """``(dataset, ok)`` as the gate counts them.

    ``configured`` counts every dataset with rows or with an error, so a failed
    extraction closes the gate; ``delivered`` counts only those that reached a
    destination.
    """
    if gate == "configured":
        return report.filter(F.col("status") != EMPTY).select("dataset", (F.col("status") == WRITTEN).alias("ok"))
    if gate == "delivered":
        return report.filter(F.col("delivered").isNotNull()).select("dataset", F.col("delivered").alias("ok"))
    raise ValueError(f"unknown gate {gate!r}")


def publish_gate(status: DataFrame, min_datasets: int = MIN_DATASETS) -> DataFrame:
    """One row ``(datasets, publish)``: enough datasets, and all of them ok."""
    return status.agg(
        F.count(F.lit(1)).alias("datasets"),
        (F.coalesce(F.bool_and("ok"), F.lit(False)) & (F.count(F.lit(1)) >= min_datasets)).alias("publish"),
    )


def refresh_rows(refreshes: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Refresh-table rows from ``(tenant, refreshed_at)``, a UTC timestamp each."""
    rows = refreshes.select(
        refresh_text(F.col("refreshed_at")).alias(REFRESHED_AT),
        F.col("tenant").alias(TENANT_COPY),
        F.col("tenant").alias(TENANT),
    )
    return conform(rows, contract, Profile())

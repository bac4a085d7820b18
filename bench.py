"""Timings of the headline work at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the sample tables, ``BENCH_CPUS`` the local cores.
Frames are consumed by the ``noop`` sink, which computes every column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfmark.columns import MONTH, PARTITION_KEYS, YEAR  # noqa: E402
from shelfmark.contracts import bundled_contracts  # noqa: E402
from shelfmark.operators import (  # noqa: E402
    cluster_by_month,
    cluster_for_write,
    conform,
    overwrite_partitions,
    partition_inventory,
    profile,
    write_partitioned,
)
from shelfmark.plans import DatasetSpec, build_dataset, fan_out, prepare, run  # noqa: E402
from shelfmark.plans.dataset import discard  # noqa: E402
from shelfmark.session import build_session, clean_scratch, scratch_path  # noqa: E402
from shelfmark.showcase.sources import DATASET_SQL, SPECS, load_tables  # noqa: E402
from shelfmark.sources import CatalogSource, list_objects  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
AS_OF = datetime(2024, 1, 15, 12)
TENANT_ID = "T0001"
SPEC = DatasetSpec("Vendas", DATASET_SQL["Vendas"])
CONTRACT = bundled_contracts()["Vendas"]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(action: Callable[[], object], times: int = 3) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def split_tables(spark: SparkSession, *names: str) -> None:
    """Lay tables out in as many files as there are cores. The sample files have one
    row group each, which a single task would read while the other cores wait."""
    for name in names:
        path = scratch_path(spark, f"bench-{name}")
        spark.table(name).repartition(int(CPUS)).write.parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)


def main(spark: SparkSession) -> dict:
    load_tables(spark, SF_DIR)
    split_tables(spark, "lineitem", "orders")
    queries: dict[str, float] = {}
    counts: dict[str, int] = {}

    def sales() -> DataFrame:
        return prepare(CatalogSource().read(spark, SPEC.query), SPEC, TENANT_ID, AS_OF)

    facts = profile(sales(), CONTRACT)
    consume(conform(sales(), CONTRACT, facts))

    queries["source_query"] = best_of(lambda: consume(CatalogSource().read(spark, SPEC.query)))
    queries["conform_known_facts"] = best_of(lambda: consume(conform(sales(), CONTRACT, facts)))
    queries["profile"] = best_of(lambda: profile(sales(), CONTRACT))
    queries["profile_and_conform"] = best_of(lambda: consume(conform(sales(), CONTRACT, profile(sales(), CONTRACT))))

    def deliver(staging: str, copies: int) -> None:
        built = build_dataset(
            spark, [SPEC], CatalogSource(), CONTRACT, TENANT_ID, AS_OF, copies=copies, staging=staging
        )
        roots = [scratch_path(spark, "bench") for _ in range(copies)]
        errors = fan_out(built.frame, roots, built.cols, tenant=TENANT_ID)
        discard(spark, built.staged)
        assert not any(errors.values()), errors

    # The JVM compiles the write path during the first deliveries.
    deliver("auto", 1)
    deliver("always", 1)
    queries["deliver"] = best_of(lambda: deliver("auto", 1))
    queries["deliver_staged"] = best_of(lambda: deliver("always", 1))
    queries["deliver_two_roots"] = best_of(lambda: deliver("auto", 2))

    def write(clustered: bool) -> str:
        found = CatalogSource().read(spark, SPEC.query)
        found = cluster_by_month(found, SPEC.date_column) if clustered else found
        root = scratch_path(spark, "bench")
        write_partitioned(conform(prepare(found, SPEC, TENANT_ID, AS_OF), CONTRACT, facts), root, PARTITION_KEYS)
        return root

    roots: dict[str, str] = {}
    queries["write_clustered"] = best_of(lambda: roots.update(clustered=write(True)))
    queries["write_unclustered"] = best_of(lambda: roots.update(scattered=write(False)))
    counts["files_clustered"] = list_objects(spark, roots["clustered"]).count()
    counts["files_unclustered"] = list_objects(spark, roots["scattered"]).count()

    target = roots["clustered"]
    march = sales().filter((F.col(YEAR) == "1996") & (F.col(MONTH) == "03"))
    month = cluster_for_write(conform(march, CONTRACT, facts), PARTITION_KEYS)
    queries["replace_month"] = best_of(lambda: overwrite_partitions(month, target, PARTITION_KEYS, tenant=TENANT_ID))
    queries["inventory"] = best_of(lambda: consume(partition_inventory(spark, target, TENANT_ID)))
    queries["plan_dry_run"] = best_of(
        lambda: consume(overwrite_partitions(sales(), target, PARTITION_KEYS, dry_run=True, tenant=TENANT_ID))
    )

    def whole_run(workers: int) -> None:
        report = run(spark, SPECS, TENANT_ID, [scratch_path(spark, "bench-run")], as_of=AS_OF, workers=workers)
        assert report.filter("status = 'written'").count() == len(SPECS) + 1

    def ledger_run() -> None:
        report = run(spark, SPECS, TENANT_ID, [scratch_path(spark, "bench-run")], as_of=AS_OF, workers=4, ledger=True)
        assert report.filter("status = 'written'").count() == len(SPECS) + 1

    queries["full_run_1_worker"] = best_of(lambda: whole_run(1))
    queries["full_run_4_workers"] = best_of(lambda: whole_run(4))
    queries["full_run_ledger"] = best_of(ledger_run, 2)
    headline = ("profile_and_conform", "deliver", "deliver_two_roots", "replace_month", "plan_dry_run",
                "full_run_4_workers")
    return {
        "metric": "headline_total",
        "value": round(sum(queries[name] for name in headline), 3),
        "unit": "sec",
        "queries": queries,
        "files": counts,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }


if __name__ == "__main__":
    session = build_session(
        "shelfmark-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.log.level": "ERROR",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    print(json.dumps(main(session)))
    clean_scratch(session)

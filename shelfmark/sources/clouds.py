"""Destination settings: cloud documents to output roots and Hadoop settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bucket_of, destination_kind

# Shape of a cloud document.
CLOUD_DOCUMENT = """
    destino struct<
        azure: struct<nomeConta: string, chaveConta: string, nomeContainer: string>,
        s3: struct<chaveAcesso: string, chaveSecreta: string, bucket: string, regiao: string>>
"""


@dataclass(frozen=True)
class Destination:
    """An output root and the Hadoop settings its file system needs."""

    kind: str
    root: str
    hadoop_conf: dict[str, str] = field(default_factory=dict, repr=False)


def read_clouds(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(CLOUD_DOCUMENT).json(path, multiLine=multi_line)


def _azure(found: Row, portal: str) -> Destination:
    host = f"{found.nomeConta}.dfs.core.windows.net"
    conf = {f"fs.azure.account.key.{host}": found.chaveConta} if found.chaveConta else {}
    return Destination("azure", f"abfss://{found.nomeContainer}@{host}/{portal}", conf)


def _s3(found: Row, portal: str) -> Destination:
    prefix = f"fs.s3a.bucket.{found.bucket}"
    settings = {
        f"{prefix}.access.key": found.chaveAcesso,
        f"{prefix}.secret.key": found.chaveSecreta,
        f"{prefix}.endpoint.region": found.regiao,
    }
    return Destination("s3", f"s3a://{found.bucket}/{portal}", {k: v for k, v in settings.items() if v})


def destinations(tenant: DataFrame, clouds: DataFrame, default_portal: str | None = None) -> list[Destination]:
    """Where a tenant's datasets go: Azure, S3 or both.

    Cloud documents are merged; when several describe the same cloud the last one
    in the file counts. ``tenant`` is the single tenant document. Both frames are
    configuration, a handful of rows.
    """
    kind, portal = tenant.select(
        F.coalesce(destination_kind(F.col("TipoDestino"), aliases=False), F.lit("ambos")),
        F.coalesce("portal", F.lit(default_portal)),
    ).first()
    if not portal:
        raise ValueError("tenant document names no portal and no default was given")
    merged: dict[str, Row] = {}
    bucket = bucket_of(F.col("destino.s3.bucket"))
    fields = clouds.select(
        "destino.azure",
        F.when(
            F.col("destino.s3").isNotNull(), F.col("destino.s3").withField("bucket", bucket)
        ).alias("s3"),
    )
    for row in fields.collect():
        merged |= {name: row[name] for name in ("azure", "s3") if row[name] is not None}
    wanted = ["azure", "s3"] if kind == "ambos" else [kind]
    absent = [name for name in wanted if name not in merged]
    if absent:
        raise ValueError(f"no cloud document describes {', '.join(absent)}")
    build = {"azure": _azure, "s3": _s3}
    return [build[name](merged[name], portal) for name in wanted]


def apply_hadoop_conf(spark: SparkSession, targets: list[Destination]) -> None:
    conf = spark._jsc.hadoopConfiguration()
    for target in targets:
        for key, value in target.hadoop_conf.items():
            conf.set(key, value)

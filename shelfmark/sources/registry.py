"""Tenant documents: dataset queries, connection and worker settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.documents import nested
from ..functions.numbers import int_or_default
from ..functions.text import without_spaces

# Shape of a tenant document. Numbers are read as text because
# documents hold them either way.
TENANT_DOCUMENT = """
    _id string, name string, TipoDestino string, portal string,
    parametrizacaoIntegracao struct<
        workers: string,
        conexaoBanco: struct<host: string, porta: string, nomeOuCaminhoBanco: string,
                             usuario: string, senha: string>,
        consultas: array<struct<name: string, query: string>>>
"""
DEFAULT_WORKERS = 4
FAULT = "_fault"


class RegistryError(LookupError):
    """The tenant is unknown or its document names no queries."""


def read_tenants(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Tenant documents from JSON; ``_id`` may be plain or in ``{"$oid": …}`` form.

    ``_fault`` holds the text of what is no such document, and is null otherwise.
    """
    schema = f"{TENANT_DOCUMENT}, {FAULT} string"
    found = spark.read.schema(schema).json(path, multiLine=multi_line, columnNameOfCorruptRecord=FAULT)
    wrapped = F.nullif(F.regexp_extract("_id", r'\$oid"\s*:\s*"([^"]+)"', 1), F.lit(""))
    return found.withColumn("_id", F.coalesce(wrapped, F.col("_id")))


def document_faults(spark: SparkSession, path: str, schema: str = TENANT_DOCUMENT, multi_line: bool = True) -> DataFrame:
    """``(file, line, text)`` of what cannot be read as a document of ``schema``: text
    that is cut off or no JSON, and fields of another kind than declared.

    ``line`` counts from 1; of files that are one document each it is 1. Documents
    are configuration, so a file is read as a whole.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    if multi_line:
        texts = files.select("file", F.lit(1).alias("line"), F.col("value").alias("text"))
        # A file may also be a list of documents.
        listed = F.from_json("text", f"array<struct<{_struct(schema)}>>", {"mode": "PERMISSIVE"})
        texts = texts.filter(~(F.col("text").startswith("[") & F.coalesce(F.size(listed) >= 0, F.lit(False)) & listed.isNotNull()))
    else:
        lines = files.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
        texts = lines.select("file", (F.col("line") + 1).alias("line"), "text")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": FAULT}
    read = F.from_json("text", f"{schema}, {FAULT} string", options)
    return texts.filter(F.trim("text") != "").filter(read[FAULT].isNotNull()).select("file", "line", "text")


def _struct(schema: str) -> str:
    """Fields of a row as fields of a struct."""
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields)


def tenant_document(tenants: DataFrame, tenant: str) -> DataFrame:
    """The one document of a tenant; an error when absent, repeated or without settings."""
    found = tenants.filter(F.col("_id") == tenant)
    rows = found.select(F.col("parametrizacaoIntegracao").isNotNull()).take(2)
    if not rows:
        # With all columns, as Spark parses those it is asked for only. Documents are few.
        broken = len(tenants.filter(F.col(FAULT).isNotNull()).collect()) if FAULT in tenants.columns else 0
        hint = f"; {broken} documents could not be read, see document_faults" if broken else ""
        raise RegistryError(f"tenant {tenant!r} not found{hint}")
    if len(rows) > 1:
        raise RegistryError(f"tenant {tenant!r} has several documents")
    if not rows[0][0]:
        raise RegistryError(f"tenant {tenant!r} has no parametrizacaoIntegracao")
    return found


def dataset_queries(tenants: DataFrame) -> DataFrame:
    """One row per configured query: ``(tenant, name, dataset, query)``."""
    queries = F.inline("parametrizacaoIntegracao.consultas").alias("name", "query")
    exploded = tenants.select(F.col("_id").alias("tenant"), queries)
    return exploded.select("tenant", "name", without_spaces(F.col("name")).alias("dataset"), "query")


def select_dataset(queries: DataFrame, name: str | None = None) -> DataFrame:
    """Only the named queries; all of them when the name is empty or unknown."""
    if not name:
        return queries
    chosen = queries.filter(F.col("name") == name)
    return queries if chosen.isEmpty() else chosen


def workers() -> Column:
    setting = nested(F.col("parametrizacaoIntegracao"), "workers")
    return int_or_default(setting, DEFAULT_WORKERS)

"""A bounded sample of labelled documents, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int) -> DataFrame:
    """At most ``bound`` rows (doc_id, text, label) whose ``doc_id`` meets ``learn``.

    Only labels 0 and 1 count. A document labelled both ways counts as 1, one
    that stands in several rows is taken once. The ids with the smallest hashes
    are chosen, so the sample does not depend on how rows are dealt out.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # ``bound`` rows of two numbers
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label"))
    )

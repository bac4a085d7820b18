"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and reread as the next stage's docs. All but the last return the columns
of ``documents``; a stage judges every row that its predecessor kept.

1. toxicity: documents with a score of at least 0.3 go;
2. quality rules: documents that the base rule or a certified cutoff fails go;
3. near-dedup: of each group linked at a similarity of 0.8 or more on five-word
   shingles, the document with the smallest doc_id stays. Of its rows with equal
   texts one stays; rows of one doc_id with different texts all stay;
4. personal data: spans are replaced by their kind in brackets;
5. packing: documents become sequences of at most 4096 tokens.

Nulls: documents without text score 0 for toxicity and go by the base rule, as
do empty ones; a row without doc_id is judged like any other and is never a
duplicate. Columns that a table has beside those of ``documents`` are passed on
by the first four stages, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import near_dup, packing, pii, quality_rules, toxicity
from shelfmark.llm.common import materialize, table
from shelfmark.llm.queries import tokenizer_path


def boxed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang, row): what operators read, and all other columns apart
    from them, so that no column of a table can clash with theirs."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", "lang", F.struct(*others).alias("row"))


def unboxed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from (row, text)."""
    return rows.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(boxed(docs), model, "row", "text")
    return unboxed(scored.filter(F.col("score") < toxicity.THRESHOLD), docs)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    statistics = quality_rules.measured(docs, "doc_id")
    cutoffs = quality_rules.select_cutoffs(materialize(statistics, "rule-statistics"), table(spark, sf_dir, "labels"))
    judged = quality_rules.verdicts(quality_rules.measured(boxed(docs), "row", "text"), cutoffs)
    return unboxed(judged.filter("kept"), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; of its rows, one of those with equal texts."""
    found = near_dup.near_duplicates(docs, percent=80)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("copy")).distinct()
    rows = boxed(docs)
    named = rows.filter("doc_id is not null")
    kept = named.join(gone, F.col("doc_id") == F.col("copy"), "left_anti")
    repeated = materialize(
        named.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("again")), "repeated-ids"
    )
    again = kept.join(repeated, F.col("doc_id") == F.col("again"), "left_semi")
    first = again.groupBy("doc_id", "text").agg(F.first("row").alias("row"))
    rest = rows.filter("doc_id is null").union(kept.join(repeated, F.col("doc_id") == F.col("again"), "left_anti"))
    return unboxed(rest.select("row", "text").union(first.select("row", "text")), docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pii.train_pii(docs)
    rows = boxed(docs).withColumn("unread", F.col("text").isNull()).withColumn("text", F.coalesce("text", F.lit("")))
    found = pii.find_pii(rows, model).select("row", "text", "unread", "found")
    clean = F.when(F.size("found") > 0, pii.redact(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    return unboxed(found.select("row", F.when(~F.col("unread"), clean).alias("text")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("near_dedup", drop_copies),
    ("pii", redact),
    ("packing", pack),
]

#: Models and packing cannot be expressed in SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

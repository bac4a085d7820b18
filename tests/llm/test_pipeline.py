from __future__ import annotations

import random

import corpus_pipeline
from test_near_dup import brute_force, edited
from test_pii import brute as personal
from test_quality_rules import brute as statistics

from shelfmark.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_sample_table(spark, sf_dir):
    """Each stage against its own input: what the rules allow, nothing else."""
    docs = table(spark, sf_dir, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == COLUMNS
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert all(not statistics(t)[5] for t in after.values())
        if name == "near_dedup":
            assert set(after) == {d for d, _, _, kept in brute_force(list(before.items()), 80) if kept}
        if name == "pii":
            assert set(after) == set(before)
            assert all(not personal(t) for t in after.values())
            assert all(after[d] == t for d, t in before.items() if "@" not in t and not any(c.isdigit() for c in t))
        else:
            assert all(before[d] == t for d, t in after.items())
        docs = spark.createDataFrame(out.collect(), out.schema)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(before)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(packed)


def test_edges_pass_through_every_stage(spark, documents, sf_dir):
    rng = random.Random(8)
    words = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = [(1, None), (2, ""), (900001, " ".join(words)), (900002, edited(rng, words, 1)), (900003, " ".join(words)), (900003, " ".join(words)), (None, " ".join(words)), (5, "x" * 50_000)]
    other = [" ".join(f"{c}{rng.randrange(3000)}" for _ in range(120)) for c in "ab"]
    rows += [(900005, other[0]), (900005, other[0]), (900005, other[1])]  # two documents of one id, one of them twice
    for rows_now in (rows, []):
        docs = documents(rows_now, "1 AS kept").selectExpr("*", "2 AS row", "'a' AS found", "3 AS score", "4 AS number", "5 AS stratum")
        names = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == names
        kept = sorted((r.doc_id for r in docs.collect()), key=str)
        assert kept == ([900001, 900005, 900005, None] if rows_now else [])
        assert {r.text for r in docs.collect() if r.doc_id == 900005} == (set(other) if rows_now else set())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == (4 if rows_now else 0)

"""Connected components of a link table, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node reachable.

    Every node points at a smaller or equal one. A round hooks the pointer of a
    node's target onto the smallest grandparent among its neighbours and then
    halves all paths, so chains shrink geometrically. Rounds end when no pointer
    moves. Each round is written to the shared folder, nothing to the driver but
    the number of moves.
    """
    edges = materialize(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct().toDF("u", "v"), "edges"
    )
    pointer = materialize(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("f")).toDF("node", "f"), "pointers")
    while True:
        target = pointer.select(F.col("node").alias("t"), F.col("f").alias("g"))
        grand = pointer.join(target, F.col("f") == F.col("t")).select("node", "f", "g")
        offers = edges.join(grand.select(F.col("node").alias("v"), F.col("g").alias("offer")), "v").select("u", "offer")
        best = offers.groupBy("u").agg(F.min("offer").alias("offer"))
        hooks = pointer.join(best.withColumnRenamed("u", "node"), "node").select(F.col("f").alias("node"), "offer")
        moved = (
            grand.select("node", F.col("g").alias("offer"))
            .union(best.select(F.col("u").alias("node"), "offer"))
            .union(hooks)
            .groupBy("node")
            .agg(F.min("offer").alias("offer"))
        )
        after = materialize(
            pointer.join(moved, "node").select("node", F.least("f", "offer").alias("f"), (F.col("offer") < F.col("f")).alias("moved")),
            "pointers",
        )
        pointer = after.select("node", "f")
        if after.filter("moved").isEmpty():
            return pointer.withColumnRenamed("f", "component")

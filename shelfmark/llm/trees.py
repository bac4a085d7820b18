"""Boosted trees: fitted by Spark's own trainer, scored as one SQL expression.

The expression needs no vectors and no model object on executors, so it can be
used inside array functions as well as on rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    feature: int
    at_most: float
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class BoostedTrees:
    """Weighted trees, or with none a constant score."""

    trees: tuple[tuple[float, Split | float], ...]
    constant: float = 0.5

    def score(self, features: list[Column]) -> Column:
        """Chance of label 1: the logistic function of twice the trees' sum."""
        if not self.trees:
            return F.lit(self.constant)
        margin = sum((F.lit(weight) * _branch(tree, features) for weight, tree in self.trees), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def _branch(node: Split | float, features: list[Column]) -> Column:
    if not isinstance(node, Split):
        return F.lit(float(node))
    return F.when(features[node.feature] <= F.lit(node.at_most), _branch(node.left, features)).otherwise(
        _branch(node.right, features)
    )


def _read(node) -> Split | float:
    if node.subtreeDepth() == 0:
        return node.prediction()
    split = node.split()
    return Split(split.featureIndex(), split.threshold(), _read(node.leftChild()), _read(node.rightChild()))


def fit_trees(rows: DataFrame, features: list[str], label: str, rounds: int, depth: int) -> BoostedTrees:
    """Trees for numeric feature columns without nulls and a label of 0 or 1.

    ``rows`` should be small or written to storage: each round reads it again.
    With rows of one label only, the model is that label; without rows, 0.5.
    """
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return BoostedTrees((), float(next(iter(counts), 0.5)))
    assembled = VectorAssembler(inputCols=features, outputCol="vector").transform(rows).select("vector", F.col(label).cast("double").alias("y"))
    trainer = GBTClassifier(
        featuresCol="vector", labelCol="y", maxIter=rounds, maxDepth=depth, maxBins=64, stepSize=0.3, seed=11, minInstancesPerNode=5
    )
    model = trainer.fit(assembled)
    return BoostedTrees(tuple((w, _read(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)))

"""Gradient-boosted trees with isotonic calibration, fitted and applied by Spark."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of either label without which nothing is fitted.
FEWEST = 10


class CalibratedTrees:
    """Scores between 0 and 1. Without enough labelled rows of both kinds, every score is `share`."""

    def __init__(self, features: list[str], trees: int = 20, depth: int = 3, seed: int = 7):
        self.assembler = VectorAssembler(inputCols=features, outputCol="_features")
        self.trees = lambda: GBTClassifier(
            featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3,
            minInstancesPerNode=5, seed=seed,
        )
        self.model, self.calibration, self.share = None, None, 0.0

    def fit(self, rows: DataFrame) -> CalibratedTrees:
        """`rows` has the features, `label` (0 or 1) and `fold` (0 or 1). Each fold is scored by trees
        fitted on the other one; these scores calibrate the trees fitted on both."""
        rows = self.assembler.transform(rows).select("_features", F.col("label").cast("double"), "fold").persist()
        try:
            n = {(r["fold"], r["label"]): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
            total = sum(n.values())
            self.share = sum(v for (_, label), v in n.items() if label == 1) / total if total else 0.0
            if min(n.get((f, label), 0) for f in (0, 1) for label in (0.0, 1.0)) < FEWEST / 2:
                return self
            self.model = self.trees().fit(rows)
            parts = [
                self.trees().fit(rows.where(F.col("fold") != f)).transform(rows.where(F.col("fold") == f))
                for f in (0, 1)
            ]
            scores = parts[0].unionByName(parts[1]).select("label", vector_to_array("probability")[1].alias("_p"))
            fitted = IsotonicRegression(featuresCol="_p", labelCol="label", predictionCol="_score")
            self.calibration = fitted.fit(scores)
        finally:
            rows.unpersist()
        return self

    def score(self, rows: DataFrame, to: str = "score") -> DataFrame:
        if self.model is None:
            return rows.withColumn(to, F.lit(self.share))
        out = self.model.transform(self.assembler.transform(rows))
        out = self.calibration.transform(out.withColumn("_p", vector_to_array("probability")[1]))
        bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_score")))
        return out.withColumn(to, bounded).drop("_features", "rawPrediction", "probability", "prediction", "_p", "_score")

"""Spark ML baselines: a boosted-tree classifier and a linear action model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_gbt(train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "y",
            seed: int = 33, rounds: int = 10) -> DataFrame:
    """Test rows with the predicted class ``yhat`` and the probability ``p1`` of class 1."""
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="__x"),
        GBTClassifier(featuresCol="__x", labelCol=label, maxIter=rounds, seed=seed)]).fit(train)
    scored = model.transform(test)
    return scored.withColumns({
        "yhat": F.col("prediction").cast("int"), "p1": vector_to_array("probability")[1],
    }).drop("__x", "rawPrediction", "probability", "prediction")


def fit_action(train: DataFrame, test: DataFrame, features: Sequence[str],
               targets: Sequence[str] = ("moved_piece", "moved_from", "moved_to")) -> DataFrame:
    """Test rows with one linear prediction per target, ``pred_<target>``."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="__x")
    fit_on, out = assembler.transform(train), assembler.transform(test)
    for target in targets:
        model = LinearRegression(featuresCol="__x", labelCol=target, predictionCol=f"pred_{target}",
                                 solver="normal", regParam=1e-6).fit(fit_on)
        out = model.transform(out)
    return out.drop("__x")

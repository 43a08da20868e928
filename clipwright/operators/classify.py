"""Binary gender scoring of embeddings by logistic regression."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = ("Female", "Male")
LEAST_CONFIDENCE = 0.65
LEAST_PER_CLASS = 5


def score(df: DataFrame, vector: str, weights: Sequence[float], bias: float, *, classes: Sequence[str] = CLASSES, least: float = LEAST_CONFIDENCE, scorer: Callable[[str], Column] | None = None) -> DataFrame:
    """``df`` with gender_predicted and gender_confidence: sigmoid of the weighted sum for the second class. Below ``least`` it is Unknown; null vectors give Unknown and 0.

    ``scorer`` takes the vector's column and gives the probability of the second class, in place of the weighted sum: any other model.
    """
    if sorted(classes) != sorted(CLASSES):
        raise ValueError(f"classes must be {CLASSES}")
    w = F.array(*(F.lit(float(x)) for x in weights))
    z = F.aggregate(F.zip_with(vector, w, lambda a, b: a.cast("double") * b), F.lit(float(bias)), lambda s, x: s + x)
    p = scorer(vector) if scorer else 1 / (1 + F.exp(-z))
    top = F.greatest(p, 1 - p)
    label = F.when(top < least, "Unknown").when(p > 0.5, classes[1]).otherwise(classes[0])
    missing = F.col(vector).isNull() | p.isNull() | F.isnan(p)
    return df.withColumn("gender_predicted", F.when(missing, "Unknown").otherwise(label)).withColumn("gender_confidence", F.when(missing, 0.0).otherwise(top))


def _numbered(df: DataFrame, vector: str, label: str, classes: Sequence[str]) -> DataFrame:
    rows = df.filter(F.col(label).isin(*classes) & F.col(vector).isNotNull())
    return rows.withColumn("_y", (F.col(label) == classes[1]).cast("double")).withColumn("_x", array_to_vector(F.col(vector)))


def train(df: DataFrame, vector: str, label: str, *, c: float = 1.0, classes: Sequence[str] = CLASSES, iterations: int = 200) -> dict:
    """Coefficients as a plain document: L2 regularised with strength 1 / (c n), without scaling. Raises below ``LEAST_PER_CLASS`` rows of a class."""
    rows = _numbered(df, vector, label, classes)
    counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < LEAST_PER_CLASS:
        raise ValueError(f"need {LEAST_PER_CLASS} rows of each class, have {counts}")
    model = LogisticRegression(featuresCol="_x", labelCol="_y", regParam=1 / (c * sum(counts.values())), standardization=False, maxIter=iterations).fit(rows)
    return {"weights": [float(x) for x in model.coefficients], "bias": float(model.intercept), "classes": list(classes), "rows": sum(counts.values())}


def fold_of(record: str, folds: int, seed: int = 42):  # noqa: ANN201
    return F.pmod(F.xxhash64(F.lit(seed), F.col(record)), F.lit(folds))


def cross_validate(df: DataFrame, vector: str, label: str, record: str, *, folds: int = 5, **settings) -> list[dict]:  # noqa: ANN003
    """Accuracy, precision and recall on each held-out fold."""
    rows, out = df.filter(F.col(label).isin(*CLASSES)).withColumn("_fold", fold_of(record, folds)), []
    for k in range(folds):
        m = train(rows.filter(F.col("_fold") != k), vector, label, **settings)
        held = score(rows.filter(F.col("_fold") == k), vector, m["weights"], m["bias"], least=0.0)
        pairs = held.select((F.col(label) == CLASSES[1]).cast("double").alias("label"), (F.col("gender_predicted") == CLASSES[1]).cast("double").alias("prediction"))
        out.append({n: MulticlassClassificationEvaluator(metricName=n).evaluate(pairs) for n in ("accuracy", "weightedPrecision", "weightedRecall")})
    return out


def to_json(model: dict) -> str:
    return json.dumps(model, sort_keys=True)


def from_json(text: str) -> dict:
    """Coefficients from a document; pickled models are never loaded."""
    model = json.loads(text)
    if list(model["classes"]) != list(CLASSES):
        raise ValueError(f"classes must be {CLASSES} in this order")
    return model

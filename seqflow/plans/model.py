"""Ops 69-71: weighted classifier on sequences, grid search on F2, batch scoring.

Sequences (ARRAY<ARRAY<DOUBLE>>) are flattened into ML vectors; class weighting is a
`weightCol` (op 38); training and scoring are Spark ML estimators, so they run on the
executors. The per-step network models of the source system are single-machine code
and are not rebuilt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.functions.scalar import threshold_label
from seqflow.operators.sequences import group_hash
from seqflow.session import materialize  # noqa: F401  (iterative fits read checkpointed rows)


FOLD = "fold"
#: a fit keeps the rows in blocks of so many MB: an array of half a heap region (1 MB at least) or more takes regions of its own,
#: so Spark's blocks of 1 MB take up to twice what its memory manager counts
BLOCK_MB = 0.25


def sequence_vectors(nested: DataFrame, features: str = "features", out: str = "x") -> DataFrame:
    """Flatten steps x features into one ML vector per sequence."""
    return nested.withColumn(out, array_to_vector(F.flatten(F.col(features))))


def _estimator(model: str, params: dict | None, label: str, weight: str | None):
    params = dict(params or {})
    common = {"featuresCol": "x", "labelCol": label}
    if model == "logistic":
        est = LogisticRegression(**{"maxBlockSizeInMB": BLOCK_MB} | common | params)
    elif model == "gbt":
        est = GBTClassifier(**common, **params)
    else:
        raise ValueError(f"unknown model {model!r}; expected 'logistic' or 'gbt'")
    if weight:
        est.setWeightCol(weight)
    return est


def fit_classifier(train: DataFrame, model: str = "logistic", params: dict | None = None,
                   label: str = "subpart_label", weight: str | None = "weight") -> PipelineModel:
    """Op 69: fit on vectorised sequences with per-row class weights."""
    data = materialize(sequence_vectors(train).drop("features"))
    return Pipeline(stages=[_estimator(model, params, label, weight)]).fit(data)


def f2_evaluator(label: str = "subpart_label", weight: str | None = None) -> MulticlassClassificationEvaluator:
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                           metricName="fMeasureByLabel", metricLabel=1.0, beta=2.0)
    if weight:
        ev.setWeightCol(weight)
    return ev


def fold_number(keys: Sequence[str], folds: int, seed: int = 42) -> Column:
    """The fold of a group: the first 8 hex digits of its seeded md5, modulo the number of folds."""
    return (F.conv(F.substring(group_hash(keys, seed), 1, 8), 16, 10).cast("long") % folds).cast("int")


def grid_search(train: DataFrame, grid: dict, model: str = "logistic", label: str = "subpart_label",
                weight: str | None = "weight", folds: int = 3, seed: int = 42, fold_by: Sequence[str] | None = None,
                keep_models: bool = False) -> CrossValidatorModel:
    """Op 70: cross-validated grid search maximising F2 of the positive class. `fold_by`: columns of a group (the part, say)
    whose rows must not lie on both sides of a fold; without it rows are dealt one by one."""
    est = _estimator(model, None, label, weight)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    cv = CrossValidator(estimator=est, estimatorParamMaps=builder.build(), evaluator=f2_evaluator(label),
                        numFolds=folds, seed=seed, parallelism=2, collectSubModels=keep_models)
    data = sequence_vectors(train).drop("features")  # a fit reads the vectors only
    if fold_by:
        cv.setFoldCol(FOLD)
        data = data.withColumn(FOLD, fold_number(fold_by, folds, seed))
    return cv.fit(materialize(data))


def score_sequences(model, nested: DataFrame, threshold: float = 0.5, machine: str = "M1",
                    keys: tuple[str, ...] = ("part_number", "subpart_no"),
                    real_label: str | None = None) -> DataFrame:
    """Op 71: probability of NG, thresholded label and the score-row shape."""
    pred = model.transform(sequence_vectors(nested))
    p = vector_to_array(F.col("probability"))[1]
    cols = [F.lit(machine).alias("machine"), *[F.col(k) for k in keys]]
    if real_label:
        cols.append(F.col(real_label).cast("double").alias("real_label"))
    cols += [threshold_label(p, threshold).alias("label"), (1 - p).alias("prob_OK"), p.alias("prob_NG")]
    return pred.select(*cols)

"""Ensemble feature ranking and the lists made from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.learning.linear import cross_validated_lasso, gather_moments
from loomcast.learning.models import FEATURES, SEED, assemble
from loomcast.operators.chunks import LENGTH, POSITION
from loomcast.operators.correlate import correlation_with, mutual_information
from loomcast.operators.ranking import add_mean_rank, align_scores, assign_lists, overlap, top_features

SCORES = ("correlation", "mutual_info", "lasso_coef", "rf_importance")
SCORE_SCHEMA = "feature string, {} double"


def blocked_folds(train: DataFrame, folds: int, share: float = 0.7) -> DataFrame:
    """Add ``fold``: equal blocks of time within the first ``share`` of each series."""
    block = F.floor(F.col(POSITION) * folds / (F.col(LENGTH) * share))
    return train.withColumn("fold", F.least(block, F.lit(folds - 1)).cast("int"))


def lasso_weights(
    train: DataFrame, features: Sequence[str], target: str, folds: int = 5, length: int = 100, ratio: float = 1e-3
) -> DataFrame:
    """Absolute weights of an L1 model; the penalty is chosen on blocks of time.

    One pass over the rows gives the moments of all folds, and the whole path of ``length``
    penalties is solved from them: for every fold without it, and for all rows.
    """
    moments = gather_moments(blocked_folds(train, folds), features, [target], "fold")
    weights = cross_validated_lasso(moments[target], length, ratio).weights if target in moments else [0.0] * len(features)
    pairs = [(c, abs(float(w))) for c, w in zip(features, weights, strict=True)]
    return train.sparkSession.createDataFrame(pairs, SCORE_SCHEMA.format("lasso_coef"))


def forest_importance(train: DataFrame, features: Sequence[str], target: str, trees: int = 100) -> DataFrame:
    """Share of each feature in the splits of a forest."""
    rows = assemble(train, features).select(target, FEATURES)
    forest = RandomForestRegressor(featuresCol=FEATURES, labelCol=target, numTrees=trees, seed=SEED).fit(rows)
    pairs = [(c, float(v)) for c, v in zip(features, forest.featureImportances.toArray())]
    return train.sparkSession.createDataFrame(pairs, SCORE_SCHEMA.format("rf_importance"))


def score_features(
    train: DataFrame, features: Sequence[str], target: str, trees: int = 100, folds: int = 5
) -> DataFrame:
    """Four scores per feature, their average ranks and the mean rank; nulls count as 0 for the fits."""
    features = list(features)
    labelled = train.where(F.col(target).isNotNull())
    filled = labelled.na.fill(0.0, features)
    correlation = correlation_with(labelled, features, target).select("feature", F.abs("correlation").alias("correlation"))
    scores = align_scores(
        [
            correlation,
            mutual_information(filled, features, target),
            lasso_weights(filled, features, target, folds=folds),
            forest_importance(filled, features, target, trees),
        ]
    )
    return add_mean_rank(scores, SCORES)


def select_lists(
    train: DataFrame, features: Sequence[str], targets: Sequence[str], horizons: Sequence[int], top_n: int = 30, **options: int
) -> tuple[DataFrame, DataFrame]:
    """Ranking on the first and last horizon: the features per horizon, and the overlap report."""
    short = top_features(score_features(train, features, targets[0], **options), top_n)
    long = top_features(score_features(train, features, targets[-1], **options), top_n)
    return assign_lists(short, long, horizons), overlap(short, long)

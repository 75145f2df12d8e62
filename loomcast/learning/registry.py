"""Model records as tables: inventory, configuration fallback, stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions.numeric import display

# Parameters reported for each model family.
REPORTED_PARAMS = {
    "RandomForest": ("numTrees", "maxDepth", "minInstancesPerNode"),
    "GradientBoosting": ("maxIter", "maxDepth", "stepSize", "subsamplingRate"),
    "Linear": ("regParam", "elasticNetParam"),
}


def inventory(tuning: DataFrame, training: DataFrame, metrics: DataFrame, kind: str = "all") -> DataFrame:
    """One row per ``(kind, horizon)``: model, parameters, sizes and test metrics."""
    joined = training.join(tuning, ["kind", "horizon"], "left").join(metrics, ["kind", "horizon"], "left")
    rows = joined if kind == "all" else joined.where(F.col("kind") == kind)
    return rows.withColumns({c: display(F.col(c), 3) for c in ("mae", "rmse", "mape", "r2")})


def resolve_configs(horizons: DataFrame, tuned: DataFrame, fallback: DataFrame, default_model: str) -> DataFrame:
    """Configuration per horizon: its own, else the one of the first stage, else the default.

    ``fallback`` holds one row; it is read as a value, not joined.
    """
    first = fallback.select("model", "params").first()
    model, params = (first["model"], first["params"]) if first else (None, None)
    joined = horizons.join(tuned.select("horizon", F.col("model").alias("own_model"), F.col("params").alias("own_params")), "horizon", "left")
    return joined.select(
        "horizon",
        F.coalesce("own_model", F.lit(model), F.lit(default_model)).alias("model"),
        F.coalesce("own_params", F.lit(params)).alias("params"),
        F.when(F.col("own_model").isNotNull(), "horizon").when(F.lit(model is not None), "first stage").otherwise("default").alias("source"),
    )


def missing_configs(horizons: DataFrame, tuned: DataFrame) -> DataFrame:
    return horizons.join(tuned, "horizon", "left_anti")


def promote(models: DataFrame, chosen: DataFrame) -> DataFrame:
    """Set the stage of the chosen ``model_id`` rows to production."""
    marked = models.join(chosen.select("model_id").distinct().withColumn("__chosen", F.lit(True)), "model_id", "left")
    return marked.withColumn("stage", F.when(F.col("__chosen"), "production").otherwise(F.col("stage"))).drop("__chosen")


def production_models(models: DataFrame) -> DataFrame:
    """Newest production model of each horizon."""
    newest = Window.partitionBy("kind", "horizon").orderBy(F.col("version").desc())
    return models.where("stage = 'production'").withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")

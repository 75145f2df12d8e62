"""The whole forecast job as one driver function over tables.

Every stage reads tables and writes tables under one folder, so a stage can be skipped when
its output is there, and nothing passes from stage to stage through the driver but small
lists (feature names, one state row per feature, one configuration per horizon).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.learning import models, selection, state
from loomcast.operators.filters import filled_columns
from loomcast.operators.metrics import average_metrics, forecast_metrics
from loomcast.operators.split import bounded_labels, chronological_split
from loomcast.sources.writers import append_rows, write_metrics, write_split_tables, write_table
from loomcast.spec import FeatureSpec, build_features, feature_columns

STAGES = ("features", "select", "preprocess", "tune", "train", "evaluate", "predict")


@dataclass(frozen=True)
class JobConfig:
    """Choices of one forecast job.

    ``first_trials`` choose the model family on the middle horizon before ``trials`` search its
    parameters on every horizon; without them every horizon searches all families.
    """

    spec: FeatureSpec
    step_unit: str = "DAY"
    top_n: int = 30
    first_trials: int = 9
    trials: int = 6
    trees: int = 100
    folds: int = 5
    imputation: str = "median"
    drop_incomplete: bool = True
    labels_cross_splits: bool = False
    parallelism: int = 4
    search_space: dict = field(default_factory=lambda: models.SEARCH_SPACE)
    default_model: models.ModelConfig = models.ModelConfig("GradientBoosting", {"maxIter": 20, "maxDepth": 5})

    def targets(self) -> dict[int, str]:
        return {h: f"y{h}" for h in self.spec.horizons}


def labelled_features(observations: DataFrame, config: JobConfig) -> DataFrame:
    """Features with split and labels ``y<h>``.

    Labels stay inside their split. With ``labels_cross_splits`` they are made first, rows
    without all labels go, and the split follows, so that labels reach into the next split.
    """
    spec = config.spec
    wide = build_features(observations, spec, targets=True)
    if config.labels_cross_splits:
        # The last label of a row is the one that ends first.
        complete = wide.where(F.col(f"`{spec.target_names()[-1]}`").isNotNull()).drop("pos", "series_rows")
        split = chronological_split(complete, spec.shape)
    else:
        split = bounded_labels(wide, spec.target, spec.horizons, spec.unit)
    renames = dict(zip(spec.target_names(), config.targets().values()))
    return split.withColumnsRenamed(renames)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table of an earlier run, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_forecast_job(
    spark: SparkSession, observations: DataFrame, config: JobConfig, folder: str, skip: Sequence[str] = ()
) -> dict[str, str]:
    """Run the stages that are not skipped; returns the path of each table."""
    unknown = set(skip) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    spec, targets = config.spec, config.targets()
    paths = {n: f"{folder}/{n}" for n in (
        "features", "lists", "overlap", "state", "categories", "prepared", "first_stage", "trials", "models", "metadata", "metrics", "metrics_json",
        "average", "forecasts",
    )}
    key = list(spec.shape.key)

    if "features" not in skip:
        write_split_tables(labelled_features(observations, config), paths["features"])
    rows = spark.read.parquet(paths["features"])
    labels = list(targets.values())
    names = [c for c in feature_columns(rows, spec) if c not in labels]
    names = filled_columns(rows.where("split = 'train'"), names)
    windowed = [c for c in names if "_lag" in c or "_roll_" in c]
    usable = rows.dropna(subset=windowed) if config.drop_incomplete else rows
    ready = usable.dropna(subset=labels)

    if "select" not in skip:
        train = ready.where("split = 'train'")
        lists, shares = selection.select_lists(
            train, names, [labels[0], labels[-1]], spec.horizons, config.top_n, trees=config.trees, folds=config.folds
        )
        write_table(lists, paths["lists"])
        write_table(shares, paths["overlap"])
    assigned = spark.read.parquet(paths["lists"]).select("horizon", "feature_type", "feature").orderBy("horizon", "feature").collect()
    own: dict[int, list[str]] = {}
    for r in assigned:
        own.setdefault(r["horizon"], []).append(r["feature"])
    kinds = {r["horizon"]: r["feature_type"] for r in assigned}
    chosen = sorted({r["feature"] for r in assigned})

    categories = [c for c in spec.categories if c in rows.columns]
    if "preprocess" not in skip:
        train = ready.where("split = 'train'")
        write_table(state.state_table(spark, state.fit_state(train, chosen, config.imputation)), paths["state"])
        codes = [
            state.category_codes(train, F.coalesce(F.col(c).cast("string"), F.lit("none"))).withColumn("feature", F.lit(c)) for c in categories
        ]
        empty = spark.createDataFrame([], "category string, code int, feature string")
        write_table(reduce(DataFrame.unionByName, codes, empty), paths["categories"])
        coded = spark.read.parquet(paths["categories"])
        outside = [c for c in (spec.target,) if c not in chosen]
        kept = usable.select(*key, spec.shape.ts, "split", *outside, *chosen, *categories, *labels)
        prepared = state.apply_state(kept, state.load_state(spark.read.parquet(paths["state"])))
        for c in categories:
            prepared = state.category_vector(prepared, c, coded.where(F.col("feature") == c))
        write_split_tables(prepared, paths["prepared"])
    prepared = spark.read.parquet(paths["prepared"])
    encoded = [f"{k}_categories" for k in categories]
    features = {h: list(dict.fromkeys([*names, *encoded])) for h, names in own.items()}

    if "tune" not in skip:
        options = dict(parallelism=config.parallelism, space=config.search_space)
        if config.first_trials:
            first, trials = models.tune_two_stage(prepared, features, targets, config.first_trials, config.trials, **options)
            write_table(first, paths["first_stage"])
        else:
            trials = models.tune_horizons(prepared, features, targets, config.trials, **options)
        write_table(trials, paths["trials"])
    tuned = models.resolved_configs(
        list(targets), stored_table(spark, paths["first_stage"]), stored_table(spark, paths["trials"]), config.default_model
    )
    configs = {h: own for h, (own, _) in tuned.items()}

    if "train" not in skip:
        model, metadata = models.train_horizons(
            prepared, features, targets, configs, feature_types=kinds, tuned={h: rmse for h, (_, rmse) in tuned.items()}
        )
        model.save(paths["models"])
        append_rows(metadata, paths["metadata"])
    model = models.MultiHorizonModel.load(paths["models"])

    if "evaluate" not in skip:
        scored = models.score_split(model, prepared, "test", targets, [*key, spec.shape.ts])
        write_metrics(forecast_metrics(scored), paths["metrics_json"], paths["metrics"], spec.unit)
        write_table(average_metrics(spark.read.parquet(paths["metrics"])), paths["average"])

    if "predict" not in skip:
        write_table(models.predict_latest(model, prepared, key, spec.shape.ts, config.step_unit), paths["forecasts"])
    return paths

"""One model per horizon: families, training, scoring, tuning."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from loomcast.functions.temporal import forecast_time, horizon_label
from loomcast.learning.linear import LinearForecast, fit_horizons
from loomcast.learning.search import Searcher, Trial, is_poor
from loomcast.operators.dedup import keep_last
from loomcast.operators.metrics import forecast_metrics

FEATURES = "__features"
SEED = 42

# Ranges of the random search, per family: choices, or (low, high) drawn as named.
SEARCH_SPACE = {
    "RandomForest": {"numTrees": ("int", 20, 100), "maxDepth": ("int", 4, 10), "minInstancesPerNode": ("int", 1, 10)},
    "GradientBoosting": {"maxIter": ("int", 10, 60), "maxDepth": ("int", 3, 6), "stepSize": ("log", 0.02, 0.3), "subsamplingRate": ("float", 0.5, 1.0)},
    "Linear": {"regParam": ("log", 0.0001, 1.0), "elasticNetParam": ("float", 0.0, 1.0)},
}
TRIAL_SCHEMA = "horizon int, trial int, model string, params map<string,string>, rmse double, mae double, share double"
METADATA_SCHEMA = "horizon int, model string, feature_type string, n_features int, n_samples bigint, tuned_rmse double, training_time double"


@dataclass(frozen=True)
class ModelConfig:
    """Model family and its parameters."""

    family: str = "GradientBoosting"
    params: Mapping[str, float] = field(default_factory=dict)

    def estimator(self, label: str, prediction: str, features: str = FEATURES):
        common = dict(featuresCol=features, labelCol=label, predictionCol=prediction)
        if self.family == "RandomForest":
            return RandomForestRegressor(**common, seed=SEED, **self.params)
        if self.family == "GradientBoosting":
            return GBTRegressor(**common, seed=SEED, **self.params)
        if self.family == "Linear":
            return LinearRegression(**common, **self.params)
        raise ValueError(f"unknown model family: {self.family}")


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="skip").transform(df)


FeatureLists = Sequence[str] | Mapping[int, Sequence[str]]


def lists_by_horizon(features: FeatureLists, horizons: Sequence[int]) -> dict[int, list[str]]:
    """Features of each horizon; one list without horizons serves all of them."""
    if isinstance(features, Mapping):
        return {h: list(features[h]) for h in horizons}
    return {h: list(features) for h in horizons}


def vector_columns(lists: Mapping[int, Sequence[str]]) -> dict[int, str]:
    """Name of the vector column of each horizon; horizons with the same list share one."""
    names: dict[tuple[str, ...], str] = {}
    return {h: names.setdefault(tuple(lists[h]), f"{FEATURES}_{len(names)}") for h in sorted(lists)}


def vectors_among(df: DataFrame, features: Sequence[str]) -> set[str]:
    """Features that are vectors themselves, such as the flags of many categories."""
    return {f.name for f in df.schema.fields if f.name in features and isinstance(f.dataType, VectorUDT)}


def complete(df: DataFrame, features: Sequence[str]) -> Column:
    """Whether a row of the frame has every feature."""
    vectors, out = vectors_among(df, features), F.lit(True)
    for c in features:
        out = out & F.col(c).isNotNull()
        if c not in vectors:
            out = out & ~F.isnan(F.col(c).cast("double"))
    return out


def with_vectors(df: DataFrame, lists: Mapping[int, Sequence[str]], named: Mapping[int, Sequence[str]] | None = None) -> DataFrame:
    """Add the vector column of every distinct list; all rows stay, missing values are NaN.

    ``named`` are the lists that the names count, where ``lists`` has some of them only.
    """
    user = {name: h for h, name in vector_columns(named or lists).items() if h in lists}
    for name, h in user.items():
        df = VectorAssembler(inputCols=list(lists[h]), outputCol=name, handleInvalid="keep").transform(df)
    return df


def _is_sum(model: Transformer) -> bool:
    """Whether a model reads its columns as they are, without a vector."""
    return isinstance(model.stages[0] if isinstance(model, PipelineModel) else model, LinearForecast)


class MultiHorizonModel(Transformer):
    """One fitted model per horizon, each over its own feature list; output is long."""

    def __init__(self, features: FeatureLists, models: Mapping[int, Transformer]) -> None:
        super().__init__()
        self.models = dict(sorted(models.items()))
        self.lists = lists_by_horizon(features, list(self.models))

    @property
    def features(self) -> list[str]:
        """Every feature that some horizon uses."""
        return list(dict.fromkeys(c for names in self.lists.values() for c in names))

    def model_for(self, horizon: int) -> Transformer | None:
        return self.models.get(horizon)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Every row once per horizon with ``horizon`` and ``yhat``; features are built once.

        A row that lacks a feature of a horizon stays, with a null ``yhat``.
        """
        kept = dataset.columns
        scored = with_vectors(dataset, {h: names for h, names in self.lists.items() if not _is_sum(self.models[h])}, self.lists)
        for model in self.models.values():
            scored = model.transform(scored)
        pairs = [
            F.struct(F.lit(h).alias("horizon"), F.when(complete(dataset, self.lists[h]), F.col(f"yhat_{h}")).alias("yhat"))
            for h in self.models
        ]
        return scored.select(*kept, F.inline(F.array(*pairs)))

    def save(self, path: str) -> None:
        """Models, and the table of their feature lists: all that ``load`` needs."""
        for h, model in self.models.items():
            PipelineModel([model]).write().overwrite().save(f"{path}/models/horizon={h}")
        rows = [(h, i, c) for h, names in self.lists.items() for i, c in enumerate(names)]
        lists = SparkSession.active().createDataFrame(rows, "horizon int, place int, feature string")
        lists.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")

    @classmethod
    def load(cls, path: str) -> MultiHorizonModel:
        lists: dict[int, list[str]] = {}
        for row in SparkSession.active().read.parquet(f"{path}/lists").orderBy("horizon", "place").collect():
            lists.setdefault(row["horizon"], []).append(row["feature"])
        return cls(lists, {h: PipelineModel.load(f"{path}/models/horizon={h}") for h in lists})


def persist_training_rows(
    df: DataFrame, lists: Mapping[int, Sequence[str]], targets: Mapping[int, str], named: Mapping[int, Sequence[str]] | None = None
) -> DataFrame:
    """Assembled rows kept for the many fits; the caller unpersists.

    ``y<h>__ready`` tells whether a row has the label and all features of a horizon, ``__slot``
    deals the rows to equal shares.
    """
    ready = [(complete(df, lists[h]) & F.col(targets[h]).isNotNull()).alias(f"{targets[h]}__ready") for h in lists]
    used = list(dict.fromkeys(c for h in lists for c in lists[h]))
    used = [c for c in used if c not in vectors_among(df, used)]
    slot = F.pmod(F.xxhash64(*used), F.lit(SLOTS)).alias("__slot")
    names = vector_columns(named or lists)
    vectors = list(dict.fromkeys(names[h] for h in lists))
    labels = list(dict.fromkeys(targets[h] for h in lists))
    return with_vectors(df, lists, named).select("split", slot, *labels, *vectors, *ready).persist()


def train_horizons(
    df: DataFrame,
    features: FeatureLists,
    targets: Mapping[int, str],
    configs: Mapping[int, ModelConfig],
    splits: Sequence[str] = ("train", "dev"),
    feature_types: Mapping[int, str] | None = None,
    tuned: Mapping[int, float] | None = None,
    parallelism: int = 4,
) -> tuple[MultiHorizonModel, DataFrame]:
    """Fit every horizon that has a configuration; returns the model and its metadata rows.

    Linear models of one feature list are fitted together, from one pass for all their horizons.
    The other fits are independent and run as concurrent Spark jobs over the same kept rows. A
    fit takes the rows that have its label and its features; ``n_samples`` counts them.
    """
    wanted = [h for h in targets if h in configs]
    lists = lists_by_horizon(features, wanted)
    chosen = df.where(F.col("split").isin(*splits))
    fitted = _fit_sums(chosen, lists, targets, configs)
    others = {h: names for h, names in lists.items() if h not in fitted}
    if others:
        fitted |= _fit_vectors(chosen, others, lists, targets, configs, parallelism)
    records = [
        (h, configs[h].family, (feature_types or {}).get(h, "ALL"), len(lists[h]), n, (tuned or {}).get(h), spent)
        for h, (_, n, spent) in sorted(fitted.items())
    ]
    model = MultiHorizonModel(lists, {h: m for h, (m, _, _) in fitted.items()})
    return model, df.sparkSession.createDataFrame(records, METADATA_SCHEMA)


Fitted = dict[int, tuple[Transformer, int, float]]


def _fit_sums(rows: DataFrame, lists: Mapping[int, Sequence[str]], targets: Mapping[int, str], configs: Mapping[int, ModelConfig]) -> Fitted:
    """Model, rows and seconds of every linear horizon."""
    out: Fitted = {}
    groups: dict[tuple[str, ...], list[int]] = {}
    for h, names in lists.items():
        if configs[h].family == "Linear" and not vectors_among(rows, names):
            groups.setdefault(tuple(names), []).append(h)
    for names, horizons in groups.items():
        started = time.perf_counter()
        penalties = {h: (configs[h].params.get("regParam", 0.0), configs[h].params.get("elasticNetParam", 0.0)) for h in horizons}
        models = fit_horizons(rows, names, targets, penalties)
        spent = (time.perf_counter() - started) / len(horizons)
        out |= {h: (model, n, spent) for h, (model, n) in models.items()}
    return out


def _fit_vectors(
    chosen: DataFrame,
    lists: Mapping[int, Sequence[str]],
    named: Mapping[int, Sequence[str]],
    targets: Mapping[int, str],
    configs: Mapping[int, ModelConfig],
    parallelism: int,
) -> Fitted:
    """Model, rows and seconds of every other horizon; models keep the vector names of ``named``."""
    vectors = vector_columns(named)
    rows = persist_training_rows(chosen, lists, targets, named)

    def fit(h: int) -> tuple[Transformer, float]:
        started = time.perf_counter()
        estimator = configs[h].estimator(targets[h], f"yhat_{h}", vectors[h])
        return estimator.fit(rows.where(f"{targets[h]}__ready")), time.perf_counter() - started

    try:
        sizes = rows.agg(*[F.count_if(f"{targets[h]}__ready").alias(str(h)) for h in lists]).first()
        with ThreadPoolExecutor(parallelism) as pool:
            fitted = dict(zip(lists, pool.map(fit, lists), strict=True))
    finally:
        rows.unpersist()
    return {h: (model, sizes[str(h)], spent) for h, (model, spent) in fitted.items()}


def predict_latest(model: MultiHorizonModel, features: DataFrame, key: Sequence[str], ts: str, unit: str) -> DataFrame:
    """One forecast per series and horizon, from the newest row that has every feature.

    A series without such a row keeps its newest row and has null forecasts where a feature is
    missing. The base time is the time of the row that was scored.
    """
    rows = features.select(*key, ts, *[c for c in model.features if c != ts], complete(features, model.features).alias("__complete"))
    newest = keep_last(rows, key, ["__complete", ts])
    short = "h" if unit == "HOUR" else ""
    return model.transform(newest).select(
        *key,
        F.col(ts).alias("base_ts"),
        F.col("horizon"),
        horizon_label(F.col("horizon"), short).alias("target"),
        forecast_time(F.col(ts), F.col("horizon"), unit).alias("forecast_ts"),
        "yhat",
    )


def score_split(model: MultiHorizonModel, df: DataFrame, split: str, targets: Mapping[int, str], keep: Sequence[str]) -> DataFrame:
    """Actual and predicted values of one split, long by horizon; every row of the split stays."""
    actual = F.element_at(F.create_map(*[x for h, t in targets.items() for x in (F.lit(h), F.col(t))]), F.col("horizon"))
    scored = model.transform(df.where(F.col("split") == split))
    return scored.select(*keep, "horizon", actual.alias("y"), "yhat")


# Shares of the training rows that a trial sees one after the other, as parts of ``SLOTS``.
SLOTS = 9
RUNGS = (1, 3, 9)


def tune_horizons(
    df: DataFrame,
    features: FeatureLists,
    targets: Mapping[int, str],
    trials: int,
    families: Sequence[str] | None = None,
    parallelism: int = 4,
    seed: int = SEED,
    space: Mapping[str, Mapping[str, tuple]] = SEARCH_SPACE,
    random_trials: int = 9,
) -> DataFrame:
    """Search per horizon: fitted on train, scored on dev; one row per trial.

    ``search.Searcher`` proposes from the trials of the horizon so far. A trial is fitted on
    growing shares of the training rows and stops at one where its dev error is above the median
    of the trials that came that far; ``share`` tells how far it came. Horizons run as concurrent
    Spark jobs, each with its own seed; splits follow time, never chance.
    """
    own_space = {f: space[f] for f in (families or space)}
    lists = lists_by_horizon(features, list(targets))
    vectors = vector_columns(lists)
    rows = persist_training_rows(df.where(F.col("split").isin("train", "dev")), lists, targets)

    def run(h: int) -> list[Trial]:
        searcher = Searcher(own_space, seed * 1000 + h, random_trials)
        labelled = rows.where(f"{targets[h]}__ready")
        dev = labelled.where("split = 'dev'")
        log: list[Trial] = []
        seen: dict[int, list[float]] = {rung: [] for rung in RUNGS}
        for _ in range(trials):
            family, params = searcher.propose(log)
            estimator = ModelConfig(family, params).estimator(targets[h], "yhat", vectors[h])
            for rung in RUNGS:
                some = labelled.where((F.col("split") == "train") & (F.col("__slot") < rung))
                if some.isEmpty():
                    continue
                pairs = estimator.fit(some).transform(dev).select(F.col(targets[h]).alias("y"), "yhat")
                score = forecast_metrics(pairs, by=()).first()
                poor = is_poor(score["rmse"], seen[rung])
                seen[rung].append(score["rmse"])
                if poor:
                    break
            log.append(Trial(family, params, score["rmse"], rung / SLOTS, score["mae"]))
        return log

    try:
        rows.count()
        with ThreadPoolExecutor(parallelism) as pool:
            logs = dict(zip(targets, pool.map(run, targets), strict=True))
    finally:
        rows.unpersist()
    records = [
        (h, i, t.family, {k: str(v) for k, v in t.params.items()}, t.score, t.mae, t.share) for h, log in logs.items() for i, t in enumerate(log)
    ]
    return df.sparkSession.createDataFrame(records, TRIAL_SCHEMA)


def _config(row: Row) -> ModelConfig:
    kinds = SEARCH_SPACE[row["model"]]
    return ModelConfig(row["model"], {k: int(float(v)) if kinds[k][0] == "int" else float(v) for k, v in row["params"].items()})


def best_configs(trials: DataFrame) -> dict[int, tuple[ModelConfig, float]]:
    """Winning configuration and its dev RMSE per horizon (one row per horizon).

    Only trials that saw all rows can win; there is always one, as the first are never stopped.
    """
    best = trials.where("share >= 1").groupBy("horizon").agg(
        F.min_by(F.struct("model", "params", "rmse"), F.struct("rmse", "trial")).alias("b")
    )
    return {row["horizon"]: (_config(row["b"]), row["b"]["rmse"]) for row in best.collect()}


def tune_two_stage(
    df: DataFrame,
    features: FeatureLists,
    targets: Mapping[int, str],
    first: int,
    second: int,
    parallelism: int = 4,
    space: Mapping[str, Mapping[str, tuple]] = SEARCH_SPACE,
) -> tuple[DataFrame, DataFrame]:
    """Choose the family on the middle horizon, then search its parameters on every horizon.

    Returns the trials of both stages; the winner of the first serves horizons without trials.
    """
    middle = sorted(targets)[len(targets) // 2]
    options = dict(parallelism=parallelism, space=space)
    stage = tune_horizons(df, features, {middle: targets[middle]}, first, **options)
    family = best_configs(stage)[middle][0].family
    # One family needs fewer random trials.
    return stage, tune_horizons(df, features, targets, second, families=(family,), random_trials=3, **options)


def resolved_configs(
    horizons: Sequence[int], first_stage: DataFrame | None, trials: DataFrame | None, default: ModelConfig
) -> dict[int, tuple[ModelConfig, float | None]]:
    """Configuration per horizon: its own winner, else that of the first stage, else the default."""
    own = best_configs(trials) if trials is not None else {}
    first = list(best_configs(first_stage).values()) if first_stage is not None else []
    fallback = first[0][0] if first else default
    return {h: own.get(h, (fallback, None)) for h in horizons}

import math
import random

import numpy as np
import pytest
from frames import hours
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from loomcast.learning import linear, models, registry, search, selection, state
from loomcast.operators.chunks import DAILY
from loomcast.operators.metrics import forecast_metrics
from loomcast.plans.forecast_job import JobConfig, labelled_features, run_forecast_job
from loomcast.session import scratch_path
from loomcast.spec import daily_spec


def frame(spark, n=400):
    rng = random.Random(4)
    rows = [(float(i), rng.random(), rng.random(), rng.random()) for i in range(n)]
    df = spark.createDataFrame(rows, "pos double, x double, z double, noise double")
    return df.select(
        F.col("pos").cast("long").alias("pos"), F.lit(n).cast("long").alias("series_rows"), "x", "z",
        (3 * F.col("x") + 0.5 * F.col("z") + 0.01 * F.col("noise")).alias("y1"),
        F.when(F.col("pos") < 0.7 * n, "train").when(F.col("pos") < 0.85 * n, "dev").otherwise("test").alias("split"),
    )


def test_state_ignores_dev_and_test(spark):
    df = frame(spark)
    train = df.where("split = 'train'")
    changed = df.withColumn("x", F.when(F.col("split") == "train", F.col("x")).otherwise(F.col("x") * 100))
    assert state.fit_state(train, ["x", "z"]) == state.fit_state(changed.where("split = 'train'"), ["x", "z"])


def test_state_order_of_steps(spark):
    """Fences come from the filled values, the deviation from the clipped ones."""
    values = [float(v) for v in range(1, 10)] + [100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    (s,) = state.fit_state(df, ["x"])
    filled = sorted(v if v is not None else 5.5 for v in values)
    q1, q3 = (filled[2] + filled[3]) / 2, (filled[7] + filled[8]) / 2
    assert (s.centre, s.lower, s.upper) == (5.5, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    clipped = [min(v, s.upper) for v in filled]
    mean = sum(clipped) / 11
    assert s.mean == pytest.approx(mean)
    assert s.std == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in clipped) / 11))
    table = state.state_table(spark, [s])
    assert state.load_state(table)[0] == s


def test_one_hot_and_ordinal(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "icon string")
    test = spark.createDataFrame([("c",), ("b",), (None,)], "icon string")
    categories = state.train_categories(train, "icon")
    assert categories == ["a", "b", "none"]
    out = state.one_hot(test, "icon", categories)
    assert out.columns == ["icon_a", "icon_b", "icon_none"] and [tuple(r) for r in out.collect()] == [(0, 0, 0), (0, 1, 0), (0, 0, 1)]
    assert [r["icon_code"] for r in state.ordinal(test, "icon", train).collect()] == [-1, 1, -1]
    with pytest.raises(ValueError, match="more than 1"):
        state.train_categories(train, "icon", most=1)


def test_clipper_is_kept_on_disk(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 10), 100]], "x double")
    path = scratch_path(spark, "clipper")
    state.IqrClipper(inputCols=["x"]).fit(df).write().overwrite().save(path)
    model = state.IqrClipperModel.load(path)
    out = model.transform(spark.createDataFrame([(100.0,), (None,), (-9.0,)], "x double"))
    assert [r["x"] for r in out.collect()] == [14.5, None, -3.5]


def test_strong_feature_ranks_first(spark):
    train = frame(spark).withColumn("junk", F.rand(seed=1)).where("split = 'train'")
    ranked = selection.score_features(train, ["x", "z", "junk"], "y1", trees=5, folds=2)
    assert ranked.orderBy("mean_rank").first()["feature"] == "x"
    folds = selection.blocked_folds(train, 5).groupBy("fold").agg(F.min("pos"), F.max("pos"), F.count("*")).orderBy("fold").collect()
    assert [f[3] for f in folds] == [56] * 5 and all(a[2] < b[1] for a, b in zip(folds, folds[1:]))


def test_tune_train_score_and_reload(spark):
    df = frame(spark)
    trials = models.tune_horizons(df, ["x", "z"], {1: "y1"}, trials=2, families=("Linear", "RandomForest"),
                                  space={"Linear": {"regParam": ("log", 1e-4, 1e-3)}, "RandomForest": {"numTrees": ("int", 3, 5)}})
    assert trials.count() == 2
    best = models.best_configs(trials)
    assert best[1][0].family == "Linear"
    model, metadata = models.train_horizons(df, ["x", "z"], {1: "y1"}, {1: best[1][0]}, tuned={1: best[1][1]})
    assert metadata.first()["n_samples"] == df.where("split IN ('train', 'dev')").count()
    path = scratch_path(spark, "models")
    model.save(path)
    again = models.MultiHorizonModel.load(path)
    scored = models.score_split(again, df, "test", {1: "y1"}, ["pos"])
    row = forecast_metrics(scored).first()
    assert row["r2"] > 0.99 and row["n_samples"] == df.where("split = 'test'").count()
    assert model.model_for(9) is None


def test_own_features_per_horizon_and_no_lost_rows(spark):
    """First and last horizon use other columns; a row without a feature keeps its place."""
    df = frame(spark).withColumn("y2", F.col("y1") + 1).withColumn("x", F.when(F.col("pos") % 10 != 5, F.col("x")))
    df = df.withColumn("series_id", F.lit("a")).withColumn("ts", F.expr("make_dt_interval(cast(pos AS int)) + timestamp_ntz'2024-01-01'"))
    linear = models.ModelConfig("Linear", {"regParam": 0.0})
    lists = {1: ["x", "z"], 2: ["z", "noise"]}
    df = df.withColumn("noise", F.rand(3))
    model, metadata = models.train_horizons(df, lists, {1: "y1", 2: "y2"}, {1: linear, 2: linear}, feature_types={1: "SHORT", 2: "LONG"})
    rows = {r["horizon"]: (r["feature_type"], r["n_features"], r["n_samples"]) for r in metadata.collect()}
    assert rows == {1: ("SHORT", 2, 306), 2: ("LONG", 2, 340)}
    path = scratch_path(spark, "models")
    model.save(path)
    again = models.MultiHorizonModel.load(path)
    assert again.lists == lists and again.features == ["x", "z", "noise"]
    scored = models.score_split(again, df, "test", {1: "y1", 2: "y2"}, ["pos"])
    assert scored.count() == 120
    assert {r["horizon"]: r["n"] for r in scored.groupBy("horizon").agg(F.count("yhat").alias("n")).collect()} == {1: 54, 2: 60}
    last = models.predict_latest(again, df.where("pos <= 395"), ["series_id"], "ts", "DAY").collect()
    assert [(r["base_ts"].day, r["yhat"] is None) for r in last] == [(29, False)] * 2  # day 394: the row before lacks nothing
    empty = models.predict_latest(again, df.where("pos = 395"), ["series_id"], "ts", "DAY").orderBy("horizon").collect()
    assert [r["yhat"] is None for r in empty] == [True, False]


def test_draw_is_repeatable_and_inside_its_ranges():
    space = models.SEARCH_SPACE["GradientBoosting"]
    a, b = (search.draw(space, random.Random(7)) for _ in range(2))
    assert a == b and 0.02 <= a["stepSize"] <= 0.3 and isinstance(a["maxDepth"], int)


def test_registry(spark):
    horizons = spark.range(1, 4).select(F.col("id").cast("int").alias("horizon"))
    tuned = spark.createDataFrame([(1, "A", "p")], "horizon int, model string, params string")
    first = spark.createDataFrame([("B", "q")], "model string, params string")
    got = {r["horizon"]: (r["model"], r["params"], r["source"]) for r in registry.resolve_configs(horizons, tuned, first, "D").collect()}
    assert got == {1: ("A", "p", "horizon"), 2: ("B", "q", "first stage"), 3: ("B", "q", "first stage")}
    bare = registry.resolve_configs(horizons, tuned, first.limit(0), "D").collect()
    assert {r["model"] for r in bare} == {"A", "D"}
    assert sorted(r["horizon"] for r in registry.missing_configs(horizons, tuned).collect()) == [2, 3]
    stored = spark.createDataFrame([("k", "m1", 1, 1, "staging"), ("k", "m2", 1, 2, "staging"), ("k", "m3", 2, 1, "staging")],
                                   "kind string, model_id string, horizon int, version int, stage string")
    promoted = registry.promote(stored, spark.createDataFrame([("m1",), ("m2",)], "model_id string"))
    assert [r["model_id"] for r in registry.production_models(promoted).collect()] == ["m2"]


def observations(spark, n=160):
    a = hours(spark, [20 + 5 * math.sin(i / 9) + (i * 7 % 5) / 10 for i in range(n)], "a", step=24)
    b = hours(spark, [15 + 4 * math.cos(i / 7) + (i * 3 % 4) / 10 for i in range(n)], "b", step=24)
    both = a.unionAll(b)
    return both.withColumns({"humidity": F.col("temp") * 2 + F.hour("ts"), "windspeed": F.pmod(F.dayofyear("ts"), F.lit(7)).cast("double"), "icon": F.when(F.col("temp") > 20, "rain")})


def job(**changes):
    spec = daily_spec(DAILY.with_chunk(64), lags={"temp": (1, 3), "humidity": (1,)}, rolls=((("windspeed",), "mean", (7,)),), horizons=(1, 2, 3))
    space = {"Linear": {"regParam": ("log", 1e-4, 1e-2)}}
    values = dict(spec=spec, top_n=4, trials=1, trees=5, folds=2, search_space={**models.SEARCH_SPACE, **space},
                  default_model=models.ModelConfig("Linear", {"regParam": 0.001}))
    return JobConfig(**{**values, **changes})


def test_labels_reach_into_the_next_split_only_when_asked(spark):
    strict = labelled_features(observations(spark), job()).where("series_id = 'a'")
    loose = labelled_features(observations(spark), job(labels_cross_splits=True)).where("series_id = 'a'")
    count = {r["split"]: r["n"] for r in strict.where("y3 IS NOT NULL").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert count == {"train": 109, "dev": 21, "test": 21}
    count = {r["split"]: r["n"] for r in loose.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert count == {"train": 109, "dev": 23, "test": 25}


def test_forecast_job_end_to_end(spark):
    folder = scratch_path(spark, "job")
    paths = run_forecast_job(spark, observations(spark), job(), folder, skip=("tune",))
    forecasts = spark.read.parquet(paths["forecasts"]).collect()
    assert {(r["series_id"], r["horizon"]) for r in forecasts} == {(s, h) for s in "ab" for h in (1, 2, 3)}
    assert all((r["forecast_ts"] - r["base_ts"]).days == r["horizon"] for r in forecasts)
    metrics = spark.read.parquet(paths["metrics"])
    assert metrics.count() == 3 and metrics.agg(F.max("mae")).first()[0] < 3
    assert spark.read.parquet(paths["lists"]).select("feature_type").distinct().count() == 3
    lists = models.MultiHorizonModel.load(paths["models"]).lists
    assigned = spark.read.parquet(paths["lists"]).collect()
    assert all({r["feature"] for r in assigned if r["horizon"] == h} == {c for c in names if "icon_" not in c} for h, names in lists.items())
    run_forecast_job(spark, observations(spark), job(), folder, skip=("features", "select", "preprocess", "tune", "train"))
    with pytest.raises(ValueError):
        run_forecast_job(spark, observations(spark), job(), folder, skip=("nothing",))


def test_job_tunes_in_two_stages(spark):
    """The middle horizon chooses the family; a horizon without trials takes the first stage's winner."""
    folder = scratch_path(spark, "job")
    space = {"Linear": {"regParam": ("log", 1e-4, 1e-2), "elasticNetParam": ("float", 0.0, 1.0)}, "RandomForest": {"numTrees": ("int", 2, 3), "maxDepth": ("int", 1, 2)}}
    config = job(first_trials=3, trials=2, search_space=space)
    paths = run_forecast_job(spark, observations(spark), config, folder, skip=("evaluate", "predict"))
    first, trials = spark.read.parquet(paths["first_stage"]), spark.read.parquet(paths["trials"])
    assert {r["horizon"] for r in first.collect()} == {2} and first.count() == 3
    assert trials.groupBy("horizon").count().where("count = 2").count() == 3
    family = models.best_configs(first)[2][0].family
    assert {r["model"] for r in trials.collect()} == {family}
    assert {r["model"] for r in spark.read.parquet(paths["metadata"]).collect()} == {family}
    some = models.resolved_configs([1, 2, 3], first, trials.where("horizon = 1"), config.default_model)
    assert some[1][1] is not None and some[3] == (models.best_configs(first)[2][0], None)
    assert models.resolved_configs([1], None, None, config.default_model)[1][0] is config.default_model


def test_five_thousand_categories_are_one_sparse_column(spark):
    train = spark.range(5000).select(F.format_string("c%05d", "id").alias("icon")).unionByName(spark.createDataFrame([(None,)], "icon string"))
    codes = state.category_codes(train, F.coalesce("icon", F.lit("none")))
    got = codes.orderBy("category").collect()
    assert [r["code"] for r in got] == list(range(5001)) and got[-1]["category"] == "none"
    rows = spark.createDataFrame([(1, "c00000"), (2, "c04999"), (3, None), (4, "unknown")], "id int, icon string")
    out = state.category_vector(rows, "icon", codes)
    assert out.columns == ["id", "icon_categories"]
    vectors = {r["id"]: r["icon_categories"] for r in out.collect()}
    assert {i: list(v.indices) for i, v in vectors.items()} == {1: [0], 2: [4999], 3: [5000], 4: []}
    assert {v.size for v in vectors.values()} == {5001}


def test_moments_of_all_targets_from_one_pass(spark):
    """Targets and features with gaps: every target uses its own complete rows."""
    rng = np.random.default_rng(2)
    x = rng.normal(1000, 1, (300, 3))
    y = np.column_stack([x @ [1.0, -2.0, 0.5] + rng.normal(0, 0.1, 300) + k for k in range(4)])
    x[rng.random(300) < 0.1, 1] = np.nan
    y[rng.random((300, 4)) < [0.0, 0.2, 0.2, 1.0]] = np.nan
    gap = lambda v: None if np.isnan(v) else float(v)
    rows = [(int(i % 3), *map(gap, x[i]), *map(gap, y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, y0 double, y1 double, y2 double, y3 double").repartition(4)
    found = linear.gather_moments(df, ["a", "b", "c"], ["y0", "y1", "y2", "y3"], "g")
    assert "y3" not in found
    for t in range(3):
        for g in range(3):
            use = (np.arange(300) % 3 == g) & ~np.isnan(x).any(axis=1) & ~np.isnan(y[:, t])
            z = np.column_stack([x[use], y[use, t]])
            m = found[f"y{t}"][g]
            assert m.n == use.sum()
            assert np.allclose(m.covariance(), np.cov(z.T, bias=True), atol=1e-9)
            assert np.allclose(m.means + m.shift, z.mean(axis=0))


@pytest.mark.parametrize("penalty,share", [(0.0, 0.0), (0.05, 0.0), (0.02, 1.0), (0.03, 0.4)])
def test_linear_models_equal_those_of_spark(spark, penalty, share):
    df = frame(spark).withColumn("flat", F.lit(3.0)).withColumn("y2", F.when(F.col("pos") % 9 != 0, F.col("x") - 2 * F.col("z")))
    features = ["x", "z", "flat"]
    fitted = linear.fit_horizons(df, features, {1: "y1", 2: "y2"}, {1: (penalty, share), 2: (penalty, share)})
    for h, label in ((1, "y1"), (2, "y2")):
        model, n = fitted[h]
        rows = models.assemble(df.where(F.col(label).isNotNull()), features)
        theirs = LinearRegression(featuresCol=models.FEATURES, labelCol=label, regParam=penalty, elasticNetParam=share, tol=1e-12, maxIter=500).fit(rows)
        assert n == rows.count()
        assert model.getOrDefault("weights") == pytest.approx(list(theirs.coefficients), abs=1e-5)
        assert model.getOrDefault("intercept") == pytest.approx(theirs.intercept, abs=1e-5)


def test_lasso_path_and_its_choice(spark):
    """Against fits of Spark ML for given penalties, and against errors counted on the rows."""
    df = selection.blocked_folds(frame(spark).where("split = 'train'").withColumn("noise", F.rand(seed=7)), 4)
    features = ["x", "z", "noise"]
    folds = linear.gather_moments(df, features, ["y1"], "fold")["y1"]
    total = sum(list(folds.values())[1:], folds[0])
    assert [m.n for m in folds.values()] == [70] * 4
    path = linear.penalty_path(total)
    assert len(path) == 100 and path[-1] == pytest.approx(path[0] / 1000)
    weights = linear.lasso_path(total, path)
    assert np.allclose(weights[0], 0) and all(np.count_nonzero(w) <= 3 for w in weights)
    rows = models.assemble(df, features)
    for k in (10, 40, 80):
        theirs = LinearRegression(featuresCol=models.FEATURES, labelCol="y1", regParam=float(path[k]), elasticNetParam=1.0, standardization=False, tol=1e-12, maxIter=1000).fit(rows)
        assert np.allclose(weights[k], theirs.coefficients.toArray(), atol=2e-4)
    chosen = linear.cross_validated_lasso(folds)
    assert chosen.penalty == chosen.penalties[int(np.argmin(chosen.errors))]
    data = np.array([(r.x, r.z, r.noise, r.y1, r.fold) for r in df.collect()])
    k = int(np.argmin(chosen.errors))
    errors = []
    for fold in range(4):
        rest, own = data[data[:, 4] != fold], data[data[:, 4] == fold]
        w = linear.lasso_path(total - folds[fold], chosen.penalties[: k + 1])[-1]
        b = rest[:, 3].mean() - rest[:, :3].mean(axis=0) @ w
        errors.append(((own[:, 3] - own[:, :3] @ w - b) ** 2).mean())
    assert chosen.errors[k] == pytest.approx(np.mean(errors))


def test_linear_horizons_are_one_job_and_reload(spark):
    df = frame(spark).withColumns({f"y{h}": F.col("x") * h + F.col("z") for h in range(2, 25)})
    targets = {h: f"y{h}" for h in range(1, 25)}
    configs = {h: models.ModelConfig("Linear", {}) for h in targets}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("linear", "24 horizons")
    model, metadata = models.train_horizons(df, ["x", "z"], targets, configs)
    jobs = len(tracker.getJobIdsForGroup("linear"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8 and metadata.count() == 24
    path = scratch_path(spark, "models")
    model.save(path)
    again = models.MultiHorizonModel.load(path)
    scored = models.score_split(again, df, "test", targets, ["pos"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Vector" not in plan
    worst = scored.where("horizon > 1").agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert worst < 1e-8


def objective(family, point):
    """A bowl per family; the least value lies in a corner of family B."""
    if family == "A":
        return 1.0 + abs(point["u"] - 0.5)
    return abs(math.log10(point["rate"]) + 2.3) + 0.1 * abs(point["depth"] - 7)


def test_search_beats_random_trials():
    space = {"A": {"u": ("float", 0.0, 1.0)}, "B": {"rate": ("log", 1e-4, 1.0), "depth": ("int", 1, 12)}}
    ours, chance = [], []
    for seed in range(40):
        log = []
        searcher = search.Searcher(space, seed)
        for _ in range(30):
            family, point = searcher.propose(log)
            log.append(search.Trial(family, point, objective(family, point)))
        ours.append(min(t.score for t in log))
        rng = random.Random(seed)
        chance.append(min(objective(f, search.draw(space[f], rng)) for f in ["A", "B"] * 15))
        assert searcher.propose(log) == search.Searcher(space, seed).propose(log)
    assert sum(ours) < 0.75 * sum(chance)


def test_stopped_trials_never_win(spark):
    assert not search.is_poor(9.0, [1.0, 2.0]) and search.is_poor(2.5, [1.0, 2.0, 3.0]) and not search.is_poor(2.0, [1.0, 2.0, 3.0])
    log = spark.createDataFrame(
        [(1, 0, "Linear", {"regParam": "0.1"}, 2.0, 1.0, 1.0), (1, 1, "RandomForest", {"numTrees": "3"}, 1.0, 1.0, 1 / 9)], models.TRIAL_SCHEMA
    )
    assert models.best_configs(log)[1][0].family == "Linear"
    worst = search.Trial("A", {"u": 0.1}, 0.0, 1 / 9)
    good = [search.Trial("A", {"u": 0.9}, float(i)) for i in range(7)]
    _, point = search.Searcher({"A": {"u": ("float", 0.0, 1.0)}}).propose([worst, *good])
    assert point["u"] > 0.5

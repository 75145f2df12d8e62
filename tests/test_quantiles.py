import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast.operators.quantiles import exact_quantiles, iqr_fences, most_frequent, quantiles_wide

P = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    heavy = np.concatenate([np.full(3000, 7.25), rng.lognormal(2, 3, 5000), rng.normal(0, 1, 999)])
    rng.shuffle(heavy)
    return heavy


@pytest.mark.parametrize("accuracy", [200, 2000, 100_000])
def test_brackets_find_the_same_values_as_sorting(spark, values, accuracy):
    """A third of all rows share one value; the sketch is far too coarse to answer by itself."""
    df = spark.createDataFrame([(float(v), float(-v)) for v in values] + [(None, None)], "x double, y double").repartition(6)
    got = {(r["feature"], r["p"]): (r["n"], r["value"]) for r in exact_quantiles(df, ["x", "y"], P, accuracy=accuracy).collect()}
    for name, sample in (("x", values), ("y", -values)):
        for p in P:
            assert got[(name, p)][0] == len(values)
            assert got[(name, p)][1] == pytest.approx(np.quantile(sample, p), rel=1e-12)


def test_groups_of_very_different_size(spark, values):
    rows = [("hot", float(v)) for v in values] + [("one", 4.0)] + [("few", float(i)) for i in range(5)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["p"]): r["value"] for r in exact_quantiles(df, ["x"], (0.25, 0.5), by=["g"], accuracy=500).collect()}
    assert got[("hot", 0.25)] == pytest.approx(np.quantile(values, 0.25))
    assert got[("one", 0.5)] == 4.0 and got[("few", 0.25)] == 1.0 and got[(None, 0.5)] == 1.0


def test_fences(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 10), 100]], "x double")
    (row,) = iqr_fences(df, ["x"]).collect()
    assert (row["q1"], row["q3"], row["lower"], row["upper"]) == (3.25, 7.75, -3.5, 14.5)


def test_wide_form(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    (row,) = quantiles_wide(df, ["x"], (0.1, 0.9)).collect()
    assert (row["q0"], row["q1"], row["n"]) == (10.0, 90.0, 101)


def test_most_frequent_smallest_wins_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "x string")
    assert most_frequent(df, "x").first()["x"] == "a"


def test_nan_and_empty_columns_at_every_accuracy(spark):
    rows = [(g, float("nan") if i % 20 == 0 else float(i), None) for g in ("a", "b") for i in range(100)]
    df = spark.createDataFrame(rows, "g string, x double, z double")
    for by in ([], ["g"]):
        for accuracy in (50, 100_000):
            found = exact_quantiles(df, ["x", "z"], (0.5, 0.99), by, accuracy).collect()
            assert len(found) == 4 * (2 if by else 1)
            assert all(r.n == 0 and r.value is None for r in found if r.feature == "z")
            values = sorted(float(i) for i in range(100) if i % 20) * (1 if by else 2)
            for r in (r for r in found if r.feature == "x"):
                assert r.n == len(values)
                assert r.value == pytest.approx(np.quantile(values, r.p))


def test_any_number_of_categories_and_empty_columns_in_state(spark):
    from loomcast.learning import state

    df = spark.range(5000).selectExpr("concat('c', lpad(id, 5, '0')) AS icon", "cast(null AS double) AS z", "cast(id AS double) AS x")
    coded = state.ordinal(df, "icon", df)
    assert coded.where("icon_code != x").count() == 0 and coded.count() == 5000
    assert len(state.train_categories(df, "icon")) == 5000
    fitted = {r["feature"]: r for r in state.fit_state(df, ["x", "z"])}
    assert fitted["z"]["centre"] is None and fitted["x"]["centre"] == 2499.5
    clipper = state.IqrClipper(inputCols=["x", "z"]).fit(df)
    assert clipper.transform(df).where("z IS NOT NULL").count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
def test_rows_that_are_sorted_together_are_bounded(spark, by):
    """Brackets are narrowed until they hold ``most`` rows, at both table sizes; values stay exact."""
    from loomcast.operators import quantiles

    rng = np.random.default_rng(9)
    p, most = (0.0, 0.01, 0.5, 0.77, 1.0), 60
    for n in (3000, 30_000):
        sample = np.concatenate([rng.lognormal(0, 2, n), np.full(n // 2, 1.5), np.full(n // 10, -3.0)])
        rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(sample)]
        df = spark.createDataFrame(rows, "g string, x double").repartition(5)
        places = [lambda m, nulls, q=q: (m - 1) * F.lit(q) for q in p]
        ranks = {"x": quantiles.Ranks(places)}
        data = df.withColumn("x__null", F.lit(False))
        brackets = quantiles.brackets_of(data, ranks, by, accuracy=50, most=most)
        targets = [quantiles._Target("x", i) for i in range(len(p))]
        inside = quantiles._inside_rows(quantiles._marked(data, brackets, by), targets, by)
        assert inside.groupBy(*by, "i").agg(F.sum("copies").alias("n")).agg(F.max("n")).first()[0] <= most
        found = quantiles.exact_quantiles(df, ["x"], p, by, accuracy=50, most=most).collect()
        for r in found:
            own = [v for g, v in rows if not by or g == r["g"]]
            assert r["value"] == pytest.approx(np.quantile(own, r["p"]), rel=1e-12), (n, r)


def test_infinite_values_and_heavy_ties_are_ordered(spark):
    values = [float("-inf")] * 40 + [0.0] * 500 + [1.0] * 7 + [2.0] * 500 + [float("inf")] * 30
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    p = (0.0, 0.01, 0.3, 0.505, 0.7, 0.99, 1.0)
    for accuracy, most in ((20, 5), (10_000, 200_000)):
        for r in exact_quantiles(df, ["x"], p, accuracy=accuracy, most=most).collect():
            rank = (len(values) - 1) * r["p"]
            left, right = values[int(rank)], values[int(np.ceil(rank))]
            assert r["value"] == pytest.approx(left if left == right else left + (right - left) * (rank - int(rank)))


@pytest.mark.parametrize("strategy", ["median", "mean"])
@pytest.mark.parametrize("missing", [0, 1, 30, 250, 900])
def test_fences_of_filled_columns_without_filling_them(spark, strategy, missing):
    """Order statistics of the column as it is give the quartiles of the filled column."""
    from loomcast.learning import state

    rng = np.random.default_rng(missing)
    known = np.round(rng.lognormal(0, 1, 400), 2)
    df = spark.createDataFrame([(float(v),) for v in known] + [(None,)] * missing, "x double").repartition(4)
    (s,) = state.fit_state(df, ["x"], strategy)
    centre = np.median(known) if strategy == "median" else known.mean()
    filled = np.concatenate([known, np.full(missing, centre)])
    q1, q3 = np.quantile(filled, [0.25, 0.75])
    assert s.centre == pytest.approx(centre)
    assert (s.lower, s.upper) == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    clipped = np.clip(filled, s.lower, s.upper)
    assert (s.mean, s.std) == pytest.approx((clipped.mean(), clipped.std()))

"""Shared score tables: naive trial log and a feature ranking, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.operators.chunks import DAILY, HOURLY
from loomcast.operators.correlate import correlation_with, mutual_information
from loomcast.operators.metrics import Pairing, paired_metrics
from loomcast.operators.ranking import add_mean_rank, align_scores, top_features
from loomcast.operators.split import split_targets
from loomcast.operators.windows import target_name, trailing
from loomcast.plans.panels import DAILY_SQL, HOURLY_HORIZONS, HOURLY_SQL, daily_panel, hourly_panel, placed_sql
from loomcast.session import settled

# Naive forecasts that serve as trials: (model, parameter text, column).
NAIVE = (
    ("Persistence", "k=0", "temp"),
    ("Lag", "k=1", "l1"),
    ("Lag", "k=23", "l23"),
    ("TrailingMean", "w=6", "m6"),
    ("TrailingMean", "w=24", "m24"),
)


def _label(horizon: int) -> str:
    return target_name("temp", horizon)


def naive_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly rows with their split, naive forecasts and labels that stay inside the split."""

    def build(w):
        lags = [F.lag("temp", 1).over(w).alias("l1"), F.lag("temp", 23).over(w).alias("l23")]
        return lags + [trailing(w, "temp", "mean", n).alias(f"m{n}") for n in (6, 24)]

    panel = hourly_panel(spark, folder).select("series_id", "ts", "temp")
    return split_targets(panel, HOURLY, "temp", HOURLY_HORIZONS, build=build, back=24)


def trial_pairings(**labels: str) -> list[Pairing]:
    """Every horizon with every naive forecast, on the dev rows."""
    return [
        Pairing({**labels, "horizon": h, "trial": i, "model": m, "params": p}, _label(h), c, ("dev",))
        for h in HOURLY_HORIZONS
        for i, (m, p, c) in enumerate(NAIVE)
    ]


def naive_trials(spark: SparkSession, folder: str) -> DataFrame:
    """Trial log ``(horizon, trial, model, params, rmse, mae)`` scored on the dev rows."""
    rows = naive_rows(spark, folder).where("split = 'dev'")
    scored = paired_metrics(rows, trial_pairings())
    return scored.select("horizon", "trial", "model", "params", "rmse", "mae")


def naive_summary(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Trials, labelled rows to train on and test errors of persistence, from one pass over the rows."""
    nothing = {"trial": -1, "model": "", "params": ""}
    counted, tested = [], []
    for h in HOURLY_HORIZONS:
        counted.append(Pairing({"part": "training", "horizon": h, **nothing}, _label(h), _label(h), ("train", "dev")))
        tested.append(Pairing({"part": "test", "horizon": h, **nothing}, _label(h), "temp", ("test",)))
    all_ = paired_metrics(naive_rows(spark, folder), [*trial_pairings(part="trial"), *counted, *tested])
    # One row per pairing, read three times.
    all_ = settled(all_, "naive-summary")
    return tuple(all_.where(F.col("part") == p) for p in ("trial", "training", "test"))


TRIALS_SQL = f"""WITH {HOURLY_SQL}, {placed_sql('h')}, cand AS (
  SELECT series_id, ts, split, temp, lag(temp, 1) OVER w AS l1, lag(temp, 23) OVER w AS l23,
    CASE WHEN count(temp) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) = 6
      THEN avg(temp) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS m6,
    CASE WHEN count(temp) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) = 24
      THEN avg(temp) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS m24
  FROM splits WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
labels AS (
  SELECT *, lead(temp, horizon) OVER (PARTITION BY series_id, split, horizon ORDER BY ts) AS y
  FROM cand, (SELECT unnest(range(1, 25))::INT AS horizon)),
tried AS (
  SELECT horizon, y, 0 AS trial, 'Persistence' AS model, 'k=0' AS params, temp AS yhat FROM labels WHERE split = 'dev'
  UNION ALL SELECT horizon, y, 1, 'Lag', 'k=1', l1 FROM labels WHERE split = 'dev'
  UNION ALL SELECT horizon, y, 2, 'Lag', 'k=23', l23 FROM labels WHERE split = 'dev'
  UNION ALL SELECT horizon, y, 3, 'TrailingMean', 'w=6', m6 FROM labels WHERE split = 'dev'
  UNION ALL SELECT horizon, y, 4, 'TrailingMean', 'w=24', m24 FROM labels WHERE split = 'dev'),
trials AS (
  SELECT horizon, trial, model, params, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae
  FROM tried WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY ALL)"""

SCORED_FEATURES = ("humidity", "windspeed", "sealevelpressure", "precip", "winddir", "uvindex", "dew")
RANK_SCORES = ("correlation", "mutual_info", "long_correlation")


def feature_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Three scores of daily columns on training rows; the last one leaves two features out."""

    wide = split_targets(daily_panel(spark, folder).select("series_id", "ts", "temp", *SCORED_FEATURES), DAILY, "temp", (1, 5)).where("split = 'train'")
    labels = [F.col(f"`target_temp_t+{h}`").alias(f"y{h}") for h in (1, 5)]
    # Every score reads these rows again.
    train = settled(wide.select(*SCORED_FEATURES, *labels), "scored-rows")
    first = correlation_with(train, SCORED_FEATURES, "y1").select("feature", F.abs("correlation").alias("correlation"))
    last = correlation_with(train, SCORED_FEATURES[:5], "y5").select("feature", F.abs("correlation").alias("long_correlation"))
    return align_scores([first, mutual_information(train, SCORED_FEATURES, "y1"), last])


def panel_ranking(spark: SparkSession, folder: str) -> DataFrame:
    ranked = add_mean_rank(feature_scores(spark, folder), RANK_SCORES)
    return top_features(ranked, len(SCORED_FEATURES))


def _mi_sql(feature: str) -> str:
    def bin_of(c: str) -> str:
        return f"least(floor(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) * 20), 19)"

    return f"""SELECT '{feature}' AS feature, sum(n / t * ln(n * t / (nx * ny))) AS mutual_info FROM (
  SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bx) AS nx, sum(n) OVER (PARTITION BY b1) AS ny FROM (
    SELECT bx, b1, count(*)::DOUBLE AS n FROM (
      SELECT {bin_of(feature)} AS bx, {bin_of('y1')} AS b1 FROM train) WHERE bx IS NOT NULL AND b1 IS NOT NULL GROUP BY 1, 2))"""


def _corr_sql(features: tuple[str, ...], target: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, {target})) AS {name} FROM train" for c in features)


SCORES_SQL = f"""WITH {DAILY_SQL}, {placed_sql('d')}, led AS (
  SELECT *, lead(temp, 1) OVER w AS y1, lead(temp, 5) OVER w AS y5 FROM splits
  WINDOW w AS (PARTITION BY series_id, split ORDER BY ts)),
train AS (SELECT * FROM led WHERE split = 'train'),
s1 AS ({_corr_sql(SCORED_FEATURES, 'y1', 'correlation')}),
s2 AS ({' UNION ALL '.join(_mi_sql(c) for c in SCORED_FEATURES)}),
s3 AS ({_corr_sql(SCORED_FEATURES[:5], 'y5', 'long_correlation')}),
scores AS (SELECT feature, correlation, mutual_info, long_correlation
  FROM s1 FULL JOIN s2 USING (feature) FULL JOIN s3 USING (feature))"""


def _rank_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 1e6::DOUBLE ELSE rank() OVER (ORDER BY {c} DESC NULLS LAST) "
        f"+ (count(*) OVER (PARTITION BY {c}) - 1) / 2 END AS {c}_rank"
    )


RANKING_SQL = f"""{SCORES_SQL}, ranks AS (
  SELECT feature, {', '.join(_rank_sql(c) for c in RANK_SCORES)} FROM scores),
mean_ranks AS (SELECT *, ({' + '.join(f'{c}_rank' for c in RANK_SCORES)}) / {len(RANK_SCORES)} AS mean_rank FROM ranks),
placed_rank AS (SELECT *, row_number() OVER (ORDER BY mean_rank, feature)::INT AS place FROM mean_ranks)"""

"""The flagship query: from raw events to forecast errors per series in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.operators.chunks import HOURLY, over_chunks
from loomcast.operators.metrics import forecast_metrics
from loomcast.operators.windows import trailing
from loomcast.plans.catalog import query, rounded, rr
from loomcast.plans.panels import HOURLY_SQL, hourly_panel

FLAGSHIP_SQL = f"""WITH {HOURLY_SQL}, f AS (
  SELECT series_id, temp, lag(temp, 1) OVER w AS lag1, lead(temp, 1) OVER w AS y,
    CASE WHEN count(temp) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) = 6
      THEN avg(temp) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS mean6
  FROM h WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
p AS (
  SELECT series_id, 'persistence' AS model, temp AS yhat, y FROM f
  UNION ALL SELECT series_id, 'previous', lag1, y FROM f
  UNION ALL SELECT series_id, 'trailing mean', mean6, y FROM f),
m AS (
  SELECT series_id, model, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
    1 - sum((y - yhat) * (y - yhat)) / (count(*) * var_pop(y)) AS r2, count(*) AS n_samples
  FROM p WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2)
SELECT series_id, model, {rr('mae rmse r2')}, n_samples FROM m"""


@query("flagship_naive_forecasts", FLAGSHIP_SQL)
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    def build(w):
        return [
            F.lag("temp", 1).over(w).alias("lag1"),
            trailing(w, "temp", "mean", 6).alias("mean6"),
            F.lead("temp", 1).over(w).alias("y"),
        ]

    rows = over_chunks(hourly_panel(spark, folder).select("series_id", "ts", "temp"), HOURLY, build, back=6, ahead=1)
    forecasts = [
        F.struct(F.lit(name).alias("model"), F.col(c).alias("yhat"))
        for name, c in (("persistence", "temp"), ("previous", "lag1"), ("trailing mean", "mean6"))
    ]
    scored = forecast_metrics(rows.select("series_id", "y", F.inline(F.array(*forecasts))), ("series_id", "model"))
    return scored.select("series_id", "model", *[rounded(c) for c in ("mae", "rmse", "r2")], "n_samples")

"""Small hand-made frames."""

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def hours(spark, values, series="a", start=START, step=1):
    rows = [(series, start + timedelta(hours=i * step), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, temp double")


def ordered(df, *columns, by="ts"):
    return [tuple(r) for r in df.orderBy(by).select(*columns).collect()]

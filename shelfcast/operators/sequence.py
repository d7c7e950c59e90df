"""Forecast from the last four weeks of features of a series, by a robust linear model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators.features import by_series
from shelfcast.operators.reshape import scan_features
from shelfcast.sources.staging import stage

# Inputs, window length, and rows beyond it that a series must have to be trained on.
SEQUENCE_COLS = [
    "sales_lag_7", "sales_lag_14", "sales_lag_28",
    "rolling_mean_7", "rolling_mean_28", "rolling_std_7",
    "day_of_week", "is_weekend", "month",
    "snap_active", "has_event", "is_promotion",
    "sell_price", "rolling_nonzero_rate_28",
]
LENGTH = 28
SPARE_ROWS = 10


def sequence_windows(rows: DataFrame, cols: list[str], length: int = LENGTH, stride: int = 1,
                     min_rows: int | None = None) -> DataFrame:
    """(id, date, window, target): the ``length`` rows before each row, oldest first, flattened.

    Windows never cross series.  Rows of shorter series are left out.
    """
    series = by_series()
    rn = F.col("rn")
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    numbered = rows.select("id", "date", F.col("sales").cast("double").alias("target"), values.alias("v")).withColumns({
        "rn": F.row_number().over(series), "n": F.count(F.lit(1)).over(Window.partitionBy("id")),
        "steps": F.collect_list("v").over(series.rowsBetween(-length, -1))})
    wanted = (rn > length) & (F.pmod(rn - length - 1, F.lit(stride)) == 0) & (F.col("n") >= (min_rows or length))
    return numbered.filter(wanted).select("id", "date", F.flatten("steps").alias("window"), "target")


def scaling_stats(rows: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, std) with the population deviation, in one pass."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    sums = rows.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
                    *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(values)])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                      for i, c in enumerate(cols)])
    return sums.select(F.explode(cells).alias("c")).select("c.*")


@dataclass
class Sequence:
    model: LinearRegressionModel
    stats: dict[str, tuple[float, float]]
    length: int = LENGTH

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        rows = [(i, c, m, s, self.length) for i, (c, (m, s)) in enumerate(self.stats.items())]
        spark.createDataFrame(rows, "at int, feature string, mean double, std double, length int").write.mode(
            "overwrite").parquet(f"{path}/stats")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Sequence:
        rows = spark.read.parquet(f"{path}/stats").orderBy("at").collect()
        return Sequence(LinearRegressionModel.load(f"{path}/model"),
                        {r["feature"]: (r["mean"], r["std"]) for r in rows}, rows[0]["length"])


def _standardised(rows: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return rows.withColumns({c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - mean) / (std or 1.0)
                             for c, (mean, std) in stats.items()})


def fit_sequence(features: DataFrame, ids: DataFrame | None = None, val_days: int = 28, length: int = LENGTH,
                 stride: int = 1, iterations: int = 50) -> Sequence:
    """Scales on training rows, takes the window of every row (or of every ``stride``-th, if asked), fits with Huber loss."""
    rows = scan_features(features, SEQUENCE_COLS, ids)
    train = rows.filter(F.col("date") <= F.date_sub(rows.agg(F.max("date")).scalar(), val_days))
    cols = [c for c in SEQUENCE_COLS if c in features.columns]
    # One row per feature.
    stats = {r["feature"]: (r["mean"] or 0.0, r["std"] or 0.0) for r in scaling_stats(train, cols).collect()}
    windows = sequence_windows(_standardised(train, stats), cols, length, stride, length + SPARE_ROWS)
    matrix = stage(windows.select(array_to_vector("window").alias("features"), "target"), "sequence_matrix")
    learner = LinearRegression(labelCol="target", loss="huber", maxIter=iterations, regParam=0.01,
                               standardization=False)
    return Sequence(learner.fit(matrix), stats, length)


def predict_sequence(model: Sequence, features: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(id, date, lstm_point) for each row that has a full window before it; not below 0."""
    rows = _standardised(scan_features(features, SEQUENCE_COLS, ids), model.stats)
    windows = sequence_windows(rows, list(model.stats), model.length)
    scored = model.model.transform(windows.select("id", "date", array_to_vector("window").alias("features")))
    return scored.select("id", "date", F.greatest("prediction", F.lit(0.0)).alias("lstm_point"))

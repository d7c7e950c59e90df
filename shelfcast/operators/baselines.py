"""Baseline forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.classify import model_routing
from shelfcast.operators.features import by_series


def naive_forecast(master: DataFrame) -> DataFrame:
    """Yesterday's sales, and the sales of the same weekday last week."""
    return master.select("id", "date", "sales", F.lag("sales", 1).over(by_series()).alias("naive_point"),
                         F.lag("sales", 7).over(by_series()).alias("seasonal_point"))


def feature_forecasts(features: DataFrame, classes: DataFrame) -> dict[str, DataFrame]:
    """One forecast table per model slot, straight from the features and routed by class.

    They cost no fit, so merging, blending and scoring can be run and checked on their own.
    """
    rows = features.filter(F.col("sales_lag_56").isNotNull())
    routing = model_routing(classes)
    points = {
        "lgbm_point": F.round("rolling_mean_28", 3),
        "prophet_point": F.round((F.col("sales_lag_7") + F.col("sales_lag_14") + F.col("sales_lag_28")) / 3.0, 3),
        "sarima_point": F.col("sales_lag_7").cast("double"),
        "lstm_point": F.round("rolling_mean_7", 3),
        "dual_point": F.round(F.col("rolling_nonzero_rate_28") * F.col("rolling_mean_28"), 4),
    }
    tables = {}
    for column, value in points.items():
        slot = column.removesuffix("_point")
        routed = routing.filter(F.col("model") == ("dual_phase" if slot == "dual" else slot)).select("id")
        kept = rows.join(routed, "id", "left_semi")
        band = [] if slot != "lgbm" else [
            F.col("rolling_min_7").cast("double").alias("lgbm_q10"),
            F.round("rolling_mean_7", 3).alias("lgbm_q50"),
            F.col("rolling_max_7").cast("double").alias("lgbm_q90")]
        tables[column] = kept.select("id", "date", value.alias(column), *band)
    return tables

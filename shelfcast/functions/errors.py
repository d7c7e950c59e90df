"""Forecast error aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(actual: Column, predicted: Column) -> Column:
    gap = (actual - predicted).cast("double")
    return F.sqrt(F.avg(gap * gap))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted).cast("double"))


def smape(actual: Column, predicted: Column) -> Column:
    """Mean of |a-p| over the mean size of the two, in percent; 0 where both are 0."""
    size = (F.abs(actual) + F.abs(predicted)) / 2.0
    return F.avg(F.when(size == 0, F.lit(0.0)).otherwise(F.abs(actual - predicted) / F.nullif(size, F.lit(0.0)))) * 100


def model_label(column: Column) -> Column:
    """``lgbm_point`` to ``Lgbm``."""
    return F.initcap(F.replace(F.replace(column, F.lit("_point"), F.lit("")), F.lit("_"), F.lit(" ")))


def series_label(series_id: Column, klass: Column) -> Column:
    return F.format_string("%s (%s)", series_id, klass)

"""Forecast scores: error metrics, scaled error, comparisons and ranking quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.errors import mae, model_label, rmse, smape
from shelfcast.sources.staging import stage

# Models whose scaled error is reported.
SCALED_MODELS = ["lgbm_point", "ensemble_point", "dual_point"]
EPS = 1e-10
# Levels at which sales and forecasts are summed before scoring.
LEVELS = {"item": "item_id", "store": "store_id", "state": "state_id"}


def forecast_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_point")]


def last_days(df: DataFrame, days: int) -> DataFrame:
    """Rows dated after the newest date less ``days``."""
    return df.filter(F.col("date") > F.date_sub(df.agg(F.max("date")).scalar(), days))


def long_forecasts(preds: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One row per forecast given: (keys, actual, model, forecast)."""
    return (
        preds.select(*keys, F.col("actual").cast("double").alias("actual"),
                     *[F.col(c).cast("double").alias(c) for c in cols])
        .unpivot([*keys, "actual"], cols, "model", "forecast")
        .filter(F.col("forecast").isNotNull() & F.col("actual").isNotNull())
    )


def scaling_factor(master: DataFrame, until=None) -> DataFrame:
    """Root mean square of the daily change per series up to ``until``; 1 when flat."""
    rows = master if until is None else master.filter(F.col("date") <= until)
    step = F.col("sales") - F.lag("sales").over(Window.partitionBy("id").orderBy("date"))
    mean = F.avg(F.col("step").cast("double") * F.col("step"))
    return (rows.select("id", step.alias("step")).groupBy("id")
            .agg(F.when(mean > 0, F.sqrt(mean)).otherwise(F.lit(1.0)).alias("scale")))


def _revenue(master: DataFrame, val_days: int) -> DataFrame:
    newest = master.agg(F.max("date")).scalar()
    return (
        master.filter((F.col("date") >= F.date_sub(newest, val_days + 28)) & (F.col("date") <= F.date_sub(newest, val_days)))
        .groupBy("id").agg(F.sum(F.col("sales") * F.col("sell_price")).alias("revenue"))
    )


def revenue_weights(master: DataFrame, val_days: int = 28) -> DataFrame:
    """Share of each series in the revenue of the 29 dates before validation."""
    revenue = _revenue(master, val_days)
    total = revenue.agg(F.sum("revenue")).scalar()
    return revenue.withColumn("weight", F.col("revenue") / (total + EPS))


def series_rmsse(preds: DataFrame, master: DataFrame, cols: list[str], val_days: int = 28, covered_only: bool = False) -> DataFrame:
    """Per series: scaled error of each forecast and weight.

    A missing forecast counts as 0, or with ``covered_only`` not at all.  One aggregate over the
    validation rows covers all ``cols``.
    """
    train_end = F.date_sub(preds.agg(F.max("date")).scalar(), val_days)
    val = last_days(preds, val_days)
    given = {c: F.col(c).cast("double") if covered_only else F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    gaps = {c: F.col("actual").cast("double") - g for c, g in given.items()}
    errors = val.groupBy("id").agg(*[F.sqrt(F.avg(g * g)).alias(c) for c, g in gaps.items()])
    scale = scaling_factor(master.join(errors.select("id"), "id", "left_semi"), train_end)
    return (
        errors.join(scale, "id", "left").join(_revenue(master, val_days), "id", "left")
        .select("id", *[(F.col(c) / (F.coalesce("scale", F.lit(1.0)) + EPS)).alias(c) for c in cols],
                F.coalesce("revenue", F.lit(0.0)).alias("weight"))
    )


def wrmsse(preds: DataFrame, master: DataFrame, cols: list[str], val_days: int = 28, covered_only: bool = False) -> DataFrame:
    """Revenue-weighted scaled error, one row per forecast column, NULL where nothing is scored.

    Weights are renormalised over the series scored; all equal when they sum to 0.
    """
    def score(c: str):
        scored = F.when(F.col(c).isNotNull(), F.col("weight"))
        return (F.when(F.sum(scored) > 0, F.sum(scored * F.col(c)) / F.nullif(F.sum(scored), F.lit(0.0)))
                .otherwise(F.avg(c)))

    per_series = series_rmsse(preds, master, cols, val_days, covered_only)
    return per_series.agg(*[score(c).alias(c) for c in cols]).unpivot([], cols, "col", "WRMSSE")


def _by_level(rows: DataFrame, **sums) -> DataFrame:
    """Daily sums per item, store, state and in all; ``id`` is ``level:key``.

    One pass with grouping sets; the total over all is summed map-side first.
    """
    keys = list(LEVELS.values())
    level = F.when(F.grouping("item_id") == 0, "item").when(F.grouping("store_id") == 0, "store").when(
        F.grouping("state_id") == 0, "state").otherwise("national")
    sets = [["date", key] for key in keys] + [["date"]]
    return (
        rows.groupingSets(sets, "date", *keys)
        .agg(level.alias("level"), *[F.sum(v).alias(k) for k, v in sums.items()])
        .select(F.concat_ws(":", "level", F.coalesce(*keys, F.lit("all"))).alias("id"), "date", *sums)
    )


def wrmsse_by_level(preds: DataFrame, master: DataFrame, cols: list[str], val_days: int = 28) -> DataFrame:
    """Scaled error per level: sales and forecasts are summed to the level, then scored there."""
    ids = master.select("id", *LEVELS.values()).distinct()
    summed = _by_level(preds.join(ids, "id"), actual=F.col("actual"),
                       **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})
    sold = _by_level(master, sales=F.col("sales"), revenue=F.col("sales") * F.col("sell_price")).withColumn(
        "sell_price", F.coalesce(F.col("revenue") / F.nullif("sales", F.lit(0)), F.lit(0.0)))
    per_series = series_rmsse(summed, sold, cols, val_days).withColumn("level", F.substring_index("id", ":", 1))
    weight = F.sum("weight")
    return (
        per_series.unpivot(["level", "weight"], cols, "col", "rmsse").groupBy("level", "col")
        .agg(F.when(weight > 0, F.sum(F.col("weight") * F.col("rmsse")) / F.nullif(weight, F.lit(0.0)))
             .otherwise(F.avg("rmsse")).alias("WRMSSE"))
    )


def model_comparison(preds: DataFrame, master: DataFrame, val_days: int = 28) -> DataFrame:
    """All forecasts over the last ``val_days`` days, in one pass over the rows."""
    cols = forecast_columns(preds)
    val = last_days(preds, val_days).filter(F.col("actual").isNotNull())
    a, p = F.col("actual"), F.col("forecast")
    scores = (
        long_forecasts(val, ["id"], cols).groupBy(F.col("model").alias("col"))
        .agg(F.countDistinct("id").alias("n_series"), F.count(F.lit(1)).alias("n_rows"),
             F.round(rmse(a, p), 4).alias("RMSE"), F.round(mae(a, p), 4).alias("MAE"),
             F.round(smape(a, p), 4).alias("SMAPE"))
    )
    scaled = [c for c in SCALED_MODELS if c in cols]
    if scaled:
        # One row per forecast column.
        scores = scores.join(F.broadcast(wrmsse(val, master, scaled, val_days)), "col", "left")
    else:
        scores = scores.withColumn("WRMSSE", F.lit(None).cast("double"))
    return scores.select(model_label(F.col("col")).alias("model"), "col", "n_series", "n_rows",
                         "RMSE", "MAE", "SMAPE", F.round("WRMSSE", 4).alias("WRMSSE"))


def per_class_metrics(preds: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or forecast_columns(preds)
    a, p = F.col("actual"), F.col("forecast")
    return (
        long_forecasts(preds.filter(F.col("demand_class").isNotNull()), ["demand_class"], cols)
        .groupBy("demand_class", "model")
        .agg(F.round(rmse(a, p), 4).alias("RMSE"), F.round(mae(a, p), 4).alias("MAE"),
             F.count(F.lit(1)).alias("n"))
    )


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve with ties counted half.

    Equal scores are merged first; the distinct ones are dealt into ranges, as many as the session
    has shuffle partitions, and ranked inside them; only the totals of the ranges are accumulated in one place.
    """
    ranged = stage(
        scored.groupBy(F.col(score).alias("s")).agg(
            F.count(F.when(F.col(label) == 1, True)).alias("pos"), F.count(F.when(F.col(label) == 0, True)).alias("neg"))
        .repartitionByRange("s").withColumn("bucket", F.spark_partition_id()), "score_ranges")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (ranged.groupBy("bucket").agg(F.sum("neg").alias("neg_in"))
              .select("bucket", F.coalesce(F.sum("neg_in").over(before), F.lit(0)).alias("neg_before")))
    inside = Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("neg_before") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    return (
        ranged.join(F.broadcast(totals), "bucket")
        .select("pos", "neg", (F.col("pos") * (below + F.col("neg") / 2.0)).alias("wins"))
        .agg((F.sum("wins") / F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("auc"))
    )

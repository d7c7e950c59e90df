"""Demand classes, their counts, and which models serve which series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.demand import ADI_LIMIT, CLASSES, CV2_LIMIT, adi, cv2, demand_class
from shelfcast.operators.reshape import ID_COLS, history_window, matching

# Which model serves which demand class.
ROUTES = {
    "sarima": ["Smooth"],
    "prophet": ["Smooth", "Erratic"],
    "lgbm": ["Smooth", "Intermittent", "Erratic", "Lumpy"],
    "lstm": ["Smooth", "Erratic"],
    "dual_phase": ["Intermittent", "Lumpy"],
}


def classify_demand(master: DataFrame, history_days: int = 365,
                    adi_limit: float = ADI_LIMIT, cv2_limit: float = CV2_LIMIT) -> DataFrame:
    """Demand interval, size variability and class of each series over its recent days.

    The other ids depend on ``id``, so grouping by them too keeps a hash aggregate with
    map-side partial sums.  Values are rounded after the class is set.
    """
    sales = F.col("sales")
    sold = F.when(sales > 0, sales)
    return (
        history_window(master, history_days)
        .groupBy(*ID_COLS)
        .agg(adi(sales).alias("adi"), cv2(sales).alias("cv2"),
             F.avg((sales == 0).cast("double")).alias("zero_rate"),
             F.coalesce(F.avg(sold), F.lit(0.0)).alias("mean_nonzero_sales"),
             F.count(F.lit(1)).alias("total_periods"), F.count(sold).alias("nonzero_periods"))
        .select(*ID_COLS, F.round("adi", 4).alias("adi"), F.round("cv2", 4).alias("cv2"),
                demand_class(F.col("adi"), F.col("cv2"), adi_limit, cv2_limit).alias("demand_class"),
                F.round("zero_rate", 4).alias("zero_rate"),
                F.round("mean_nonzero_sales", 4).alias("mean_nonzero_sales"),
                "total_periods", "nonzero_periods")
    )


def series_by_class(classes: DataFrame, klass: str) -> DataFrame:
    return classes.filter(F.col("demand_class") == klass).select("id")


def class_distribution(classes: DataFrame) -> DataFrame:
    """Series and share per class; the unpartitioned window sees one row per class."""
    total = F.sum("n_series").over(Window.partitionBy())
    return (classes.groupBy("demand_class").agg(F.count(F.lit(1)).alias("n_series"))
            .withColumn("pct", F.round(F.col("n_series") * 100.0 / total, 1)))


def demand_class_counts(classes: DataFrame, state_id: str | None = None, store_id: str | None = None,
                        cat_id: str | None = None) -> DataFrame:
    return (classes.filter(matching(state_id=state_id, store_id=store_id, cat_id=cat_id))
            .groupBy(F.col("demand_class").alias("class")).agg(F.count(F.lit(1)).alias("count")))


def routes(spark: SparkSession) -> DataFrame:
    """The fixed (class, model) pairs with the rank of the class, 11 rows."""
    rows = [(klass, model, CLASSES.index(klass)) for model, served in ROUTES.items() for klass in served]
    return spark.createDataFrame(rows, "demand_class string, model string, class_rank int")


def model_routing(classes: DataFrame) -> DataFrame:
    """(model, id, demand_class) for every model a series is routed to.

    The route table is expanded in place: joining on four class names would put all
    series of a class in one task.
    """
    served = F.create_map(*[
        part for klass in CLASSES
        for part in (F.lit(klass), F.array(*[F.lit(m) for m, ks in ROUTES.items() if klass in ks]))])
    return classes.select("id", "demand_class", F.explode(served[F.col("demand_class")]).alias("model"))


def cap_routing(routing: DataFrame, n: int) -> DataFrame:
    """The first ``n`` series of each model, by class and then id.

    A bounded top-n per model, so no task sorts all series of a model.
    """
    rank = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("demand_class"))
    parts = [routing.filter(F.col("model") == model).orderBy(rank, "id").limit(n) for model in ROUTES]
    capped = parts[0]
    for part in parts[1:]:
        capped = capped.unionByName(part)
    return capped

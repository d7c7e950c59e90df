"""Report queries over the blended forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import week_start
from shelfcast.functions.errors import mae, rmse, series_label
from shelfcast.functions.demand import CLASSES
from shelfcast.operators.classify import ROUTES
from shelfcast.operators.reshape import history_window, matching

# Money at risk per series that may run out, and the listing limit.
RISK_PER_SERIES = 150
LIST_LIMIT = 200


def _filtered(preds: DataFrame, classes: DataFrame, **wanted: str | None) -> DataFrame:
    """Forecast rows of the series that match; all rows when nothing is asked."""
    if not any(wanted.values()):
        return preds
    return preds.join(classes.filter(matching(**wanted)).select("id"), "id", "left_semi")


def prediction_date_range(preds: DataFrame) -> DataFrame:
    return preds.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def filter_options(classes: DataFrame) -> DataFrame:
    """Choices of the report filters: (option, value), the fixed class list included."""
    cols = {"states": "state_id", "stores": "store_id", "categories": "cat_id"}
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("option"), F.col(c).alias("value")) for k, c in cols.items()]))
    fixed = classes.sparkSession.createDataFrame([("demand_classes", c) for c in CLASSES], "option string, value string")
    return (classes.select(kinds.alias("o")).select("o.*").filter(F.col("value").isNotNull())
            .distinct().unionByName(fixed).orderBy("option", "value"))


def filtered_items(classes: DataFrame, state_id: str | None = None, store_id: str | None = None,
                   cat_id: str | None = None, limit: int = LIST_LIMIT) -> DataFrame:
    return (classes.filter(matching(state_id=state_id, store_id=store_id, cat_id=cat_id))
            .select("id", "demand_class", series_label(F.col("id"), F.col("demand_class")).alias("label"))
            .orderBy("id").limit(limit))


def stores_in_state(classes: DataFrame, state_id: str | None = None) -> DataFrame:
    return classes.filter(matching(state_id=state_id)).select("store_id").distinct().orderBy("store_id")


def with_quantiles(preds: DataFrame, quantiles: DataFrame) -> DataFrame:
    return preds.join(quantiles.select("id", "date", "lgbm_q10", "lgbm_q90"), ["id", "date"], "left")


def _kpi_row(rows: DataFrame) -> DataFrame:
    """Sums per series first, so the two distinct counts need no row expansion."""
    f, a = F.col("ensemble_point"), F.col("actual")
    runs_out = (F.col("lgbm_q10") == 0) & (f > 1)
    piles_up = (F.col("lgbm_q90") > f * 3.0) & (f > 0)
    per_series = rows.groupBy("id").agg(
        F.sum(F.abs(a - f)).alias("missed"), F.sum(a).alias("sold"),
        F.max(F.coalesce(runs_out, F.lit(False)).cast("int")).alias("runs_out"),
        F.max(F.coalesce(piles_up, F.lit(False)).cast("int")).alias("piles_up"))
    accuracy = F.round((F.lit(1.0) - F.sum("missed") / (F.sum("sold") + 1e-10)) * 100.0, 1)
    return (
        per_series.agg(
            F.when(F.count(F.lit(1)) > 0, F.greatest(F.lit(0.0), accuracy)).alias("accuracy"),
            F.coalesce(F.sum("runs_out"), F.lit(0)).cast("bigint").alias("stockout_alerts"),
            F.coalesce(F.sum("piles_up"), F.lit(0)).cast("bigint").alias("overstock_alerts"),
            F.coalesce(F.sum("sold"), F.lit(0)).cast("bigint").alias("total_sales"))
        .withColumn("revenue_at_risk", F.col("stockout_alerts") * RISK_PER_SERIES)
    )


def overview_kpis(preds: DataFrame, classes: DataFrame, quantiles: DataFrame, state_id: str | None = None,
                  store_id: str | None = None, cat_id: str | None = None, days: int = 28) -> DataFrame:
    """Accuracy, alerts and sales over the newest ``days + 1`` dates; no row means NULL accuracy."""
    recent = history_window(preds, days)
    recent = _filtered(recent, classes, state_id=state_id, store_id=store_id, cat_id=cat_id)
    return _kpi_row(with_quantiles(recent, quantiles))


def weekly_trend(preds: DataFrame, classes: DataFrame, state_id: str | None = None,
                 store_id: str | None = None, cat_id: str | None = None) -> DataFrame:
    rows = _filtered(preds, classes, state_id=state_id, store_id=store_id, cat_id=cat_id)
    return (rows.groupBy(week_start("date").alias("date"))
            .agg(F.sum("actual").cast("bigint").alias("actual"), F.sum("ensemble_point").alias("forecast"))
            .orderBy("date"))


def forecast_slice(preds: DataFrame, quantiles: DataFrame, series_id: str, start: str, end: str) -> DataFrame:
    """Actual, all forecasts and the band of one series between two dates."""
    def wanted(df: DataFrame) -> DataFrame:
        return df.filter((F.col("id") == series_id) & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))

    points = [c for c in preds.columns if c.endswith("_point")]
    return (with_quantiles(wanted(preds), wanted(quantiles))
            .select("date", "actual", *points, "lgbm_q10", "lgbm_q90").orderBy("date"))


def series_badges(preds: DataFrame, series_id: str, start: str, end: str) -> DataFrame:
    rows = preds.filter((F.col("id") == series_id)
                        & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
                        & F.col("actual").isNotNull() & F.col("ensemble_point").isNotNull())
    a, p = F.col("actual"), F.col("ensemble_point")
    return rows.agg(F.round(mae(a, p), 2).alias("MAE"), F.round(rmse(a, p), 2).alias("RMSE"))


def prediction_coverage(preds: dict[str, DataFrame], routing: DataFrame) -> DataFrame:
    """Per model: forecast rows, series covered, series routed, and the state of the table.

    Rows are first counted per (model, id), so no distinct count sees raw rows.
    """
    names = {m: ("dual_phase" if m == "dual" else m) for m in preds}
    got = None
    for model, table in preds.items():
        part = table.groupBy("id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(names[model]).alias("model"), "id", "n")
        got = part if got is None else got.unionByName(part)
    expected = routing.groupBy("model").agg(F.count(F.lit(1)).alias("expected_series"))
    fixed = routing.sparkSession.createDataFrame([(m,) for m in ROUTES], "model string")
    if got is None:
        have = fixed.withColumns({"n_rows": F.lit(0).cast("bigint"), "n_series": F.lit(0).cast("bigint")})
    else:
        have = fixed.join(got.groupBy("model").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_series")),
                          "model", "left")
    rows, done = F.coalesce("n_rows", F.lit(0).cast("bigint")), F.coalesce("n_series", F.lit(0).cast("bigint"))
    want = F.coalesce("expected_series", F.lit(0).cast("bigint"))
    known = F.col("model").isin([names[m] for m in preds])
    return have.join(expected, "model", "left").select(
        "model", rows.alias("n_rows"), done.alias("n_series"), want.alias("expected_series"),
        F.when(~known, "missing").when(done >= want, "complete").otherwise("partial").alias("state"))


def incomplete_models(coverage: DataFrame) -> DataFrame:
    """Models that still have to run."""
    return coverage.filter(F.col("state") != "complete").select("model")


def risk_grid(preds: DataFrame, quantiles: DataFrame, days: int = 28) -> DataFrame:
    """Colour per series and date: red may run out, amber may pile up, else green."""
    f = F.col("ensemble_point")
    colour = (F.when((F.col("lgbm_q10") == 0) & (f > 1), "red")
              .when((F.col("lgbm_q90") > f * 3.0) & (f > 0), "amber").otherwise("green"))
    return with_quantiles(history_window(preds, days), quantiles).select("id", "date", colour.alias("risk"))


def kpi_change(preds: DataFrame, days: int = 28) -> DataFrame:
    """Accuracy and sales of the newest window against the one before it."""
    newest = preds.agg(F.max("date")).scalar()
    a, f = F.col("actual"), F.col("ensemble_point")
    now = F.col("date") >= F.date_sub(newest, days)

    def accuracy(period):
        miss = F.sum(F.when(period, F.abs(a - f)))
        return F.round((F.lit(1.0) - miss / (F.sum(F.when(period, a)) + 1e-10)) * 100.0, 1)

    return (
        preds.filter(F.col("date") >= F.date_sub(newest, 2 * days + 1))
        .agg(F.greatest(F.lit(0.0), accuracy(now)).alias("accuracy"),
             F.greatest(F.lit(0.0), accuracy(~now)).alias("accuracy_before"),
             F.coalesce(F.sum(F.when(now, a)), F.lit(0)).cast("bigint").alias("total_sales"),
             F.coalesce(F.sum(F.when(~now, a)), F.lit(0)).cast("bigint").alias("total_sales_before"))
    )

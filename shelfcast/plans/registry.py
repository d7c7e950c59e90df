"""Named queries over the benchmark tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.errors import mae, model_label, rmse, series_label, smape
from shelfcast.operators import boosted, classify, decompose, dual, features, reshape, scoring, seasonal_arima, sequence, serving
from shelfcast.operators.baselines import naive_forecast
from shelfcast.operators.blend import AVAILABILITY, active_ids
from shelfcast.plans import jobs
from shelfcast.plans.oracle import with_steps
from shelfcast.plans.tables import Tables
from shelfcast.sources import raw_files
from shelfcast.sources.staging import new_path, stage
from shelfcast.sources.store import TableStore, table_counts

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function from the tables of a run to a DataFrame."""
    def register(fn: Callable[[Tables], DataFrame]):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_steps(sql) for name, sql in _SQL.items()}


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Doubles that depend on the order of addition, cut to comparable digits."""
    return df.withColumns({c: F.round(c, places) for c in cols})


# ---- reshape, join, filter -------------------------------------------------------------

@query("master", "SELECT * FROM master")
def _(t):
    return t.master


@query("sales_calendar_join", """
    SELECT year, month, event_type_1, CAST(count(*) AS BIGINT) AS n, CAST(sum(s.sales) AS BIGINT) AS units
    FROM panel s JOIN calendar c ON s.d = c.d GROUP BY year, month, event_type_1""")
def _(t):
    return (t.raw.sales.join(t.raw.calendar, "d").groupBy("year", "month", "event_type_1")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("sales").alias("units")))


@query("price_join", """
    SELECT id, CAST(count(*) FILTER (sell_price = 0) AS BIGINT) AS unpriced, round(sum(sales * sell_price), 2) AS revenue
    FROM master GROUP BY id""")
def _(t):
    return t.master.groupBy("id").agg(F.count(F.when(F.col("sell_price") == 0, True)).alias("unpriced"),
                                      F.round(F.sum(F.col("sales") * F.col("sell_price")), 2).alias("revenue"))


@query("table_counts", """
    SELECT 'raw_sales' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM panel
    UNION ALL SELECT 'raw_calendar', count(*) FROM calendar UNION ALL SELECT 'raw_prices', count(*) FROM prices
    UNION ALL SELECT 'master', count(*) FROM master UNION ALL SELECT 'demand_classes', count(*) FROM classes""")
def _(t):
    return table_counts({"raw_sales": t.raw.sales, "raw_calendar": t.raw.calendar, "raw_prices": t.raw.prices,
                         "master": t.master, "demand_classes": t.classes})


@query("id_subset", """
    SELECT id, date, sales FROM master WHERE id IN (SELECT id FROM classes WHERE demand_class = 'Lumpy')""")
def _(t):
    return reshape.keep_ids(t.master, classify.series_by_class(t.classes, "Lumpy")).select("id", "date", "sales")


@query("sample_series", """
    SELECT id FROM (SELECT DISTINCT id FROM demand) ORDER BY md5(id || ':42'), id LIMIT 20""")
def _(t):
    return reshape.sample_series(t.master, 20)


@query("history_window", """
    SELECT date, CAST(count(*) AS BIGINT) AS n, CAST(sum(sales) AS BIGINT) AS units FROM master
    WHERE date >= (SELECT max(date) FROM master) - 365 GROUP BY date""")
def _(t):
    return (reshape.history_window(t.master, 365).groupBy("date")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("sales").alias("units")))


@query("time_split", """
    SELECT date > (SELECT max(date) FROM usable) - 28 AS is_val, CAST(count(*) AS BIGINT) AS n,
           min(date) AS first_date, max(date) AS last_date, CAST(sum(sales) AS BIGINT) AS units FROM usable GROUP BY 1""")
def _(t):
    usable = reshape.scan_features(features.add_lags(t.master), features.MODEL_COLS)
    return (reshape.time_split(usable, 28).groupBy("is_val")
            .agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                 F.sum("sales").alias("units")))


@query("null_row_drop", """
    SELECT id, CAST(count(*) AS BIGINT) AS n, min(date) AS first_date FROM features
    WHERE sales_lag_28 IS NOT NULL AND rolling_mean_28 IS NOT NULL GROUP BY id""")
def _(t):
    lagged = features.add_rolling(features.add_lags(t.master))
    return (reshape.drop_null_rows(lagged, ["sales_lag_28", "rolling_mean_28"]).groupBy("id")
            .agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date")))


@query("feature_scan", """
    SELECT id, date, sales, sales_lag_7, sales_lag_56, round(rolling_mean_28, 6) AS rolling_mean_28, day_of_week,
           sell_price FROM usable WHERE id IN (SELECT id FROM classes WHERE demand_class IN ('Smooth', 'Erratic'))""")
def _(t):
    ids = t.classes.filter(F.col("demand_class").isin("Smooth", "Erratic"))
    cols = ["sales_lag_7", "sales_lag_56", "rolling_mean_28", "day_of_week", "sell_price", "not_there"]
    return rounded(reshape.scan_features(t.features, cols, ids), "rolling_mean_28")


@query("single_series", "SELECT date, sales FROM master WHERE id = 'ECONOMY_ALL' ORDER BY date")
def _(t):
    return reshape.single_series(t.master, "ECONOMY_ALL")


@query("optional_filters", """
    SELECT 'none' AS filter, CAST(count(*) AS BIGINT) AS n FROM classes
    UNION ALL SELECT 'state', count(*) FROM classes WHERE state_id = 'TX'
    UNION ALL SELECT 'state_store', count(*) FROM classes WHERE state_id = 'TX' AND store_id = 'AMERICA'
    UNION ALL SELECT 'all', count(*) FROM classes WHERE state_id = 'TX' AND store_id = 'AMERICA' AND cat_id = 'CAT_1'""")
def _(t):
    asked = {"none": {}, "state": {"state_id": "TX"}, "state_store": {"state_id": "TX", "store_id": "AMERICA"},
             "all": {"state_id": "TX", "store_id": "AMERICA", "cat_id": "CAT_1"}}
    return reshape.stack([
        t.classes.filter(reshape.matching(**wanted)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("filter"), "n")
        for name, wanted in asked.items()])


@query("ordered_panel", "SELECT id, date, sales, sell_price FROM master")
def _(t):
    return reshape.ordered_panel(t.master.select("id", "date", "sales", "sell_price"))


# ---- features --------------------------------------------------------------------------

def _feature_group(name: str, cols: list[str], build, doubles: list[str] = ()):
    shown = ", ".join(f"round({c}, 6) AS {c}" if c in doubles else c for c in cols)

    @query(name, f"SELECT id, date, {shown} FROM features")
    def _(t):
        return rounded(build(t.master).select("id", "date", *cols), *doubles)


_feature_group("calendar_features", [
    "day_of_week", "week_of_year", "month", "year", "quarter", "is_weekend", "is_month_start", "is_month_end",
    "dow_sin", "dow_cos", "month_sin", "month_cos"], features.add_calendar)
_feature_group("event_features", [*features.EVENT_KINDS, "has_event", "snap_active"], features.add_events)
_feature_group("price_features", ["price_roll30", "price_change_pct", "is_promotion", "days_since_price_change"],
               features.add_price, ["price_roll30"])
_feature_group("lag_features", [f"sales_lag_{k}" for k in features.LAGS], features.add_lags)
_feature_group("rolling_features", ["rolling_mean_7", "rolling_mean_28", "rolling_std_7", "rolling_std_28",
                                    "rolling_min_7", "rolling_max_7"], features.add_rolling,
               ["rolling_mean_7", "rolling_mean_28", "rolling_std_7", "rolling_std_28"])
_feature_group("demand_features", ["days_since_last_sale", "rolling_nonzero_rate_28"], features.add_demand,
               ["rolling_nonzero_rate_28"])
_FLOATS = ["rolling_mean_7", "rolling_mean_28", "rolling_std_7", "rolling_std_28", "rolling_nonzero_rate_28"]
_feature_group("feature_table", ["sales", *features.MODEL_COLS], features.build_features, _FLOATS)


@query("naive_forecast", """
    SELECT id, date, sales, yday AS naive_point, sales_lag_7 AS seasonal_point FROM lagged""")
def _(t):
    return naive_forecast(t.master)


@query("last_n_per_series", """
    SELECT id, date, dual_point FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC) AS rn FROM pred_dual)
    WHERE rn <= 28""")
def _(t):
    return reshape.last_n_per_series(t.preds["dual_point"], 28)


# ---- classes and routing ---------------------------------------------------------------

@query("demand_classes", "SELECT * FROM classes")
def _(t):
    return classify.classify_demand(t.master)


@query("adi", "SELECT id, adi, total_periods, nonzero_periods FROM classes")
def _(t):
    return classify.classify_demand(t.master).select("id", "adi", "total_periods", "nonzero_periods")


@query("cv2", "SELECT id, cv2, mean_nonzero_sales FROM classes")
def _(t):
    return classify.classify_demand(t.master).select("id", "cv2", "mean_nonzero_sales")


@query("demand_classes_activity", """
    SELECT id, round(CASE WHEN nz = 0 THEN 'inf'::DOUBLE ELSE CAST(n AS DOUBLE) / nz END, 4) AS adi,
           round(coalesce(cv2_raw, 0), 4) AS cv2,
           CASE WHEN n >= 1.32::DOUBLE * nz THEN CASE WHEN coalesce(cv2_raw, 0) >= 0.49::DOUBLE THEN 'Lumpy' ELSE 'Intermittent' END
                WHEN coalesce(cv2_raw, 0) >= 0.49::DOUBLE THEN 'Erratic' ELSE 'Smooth' END AS demand_class
    FROM (SELECT id, count(*) AS n, count(*) FILTER (s > 0) AS nz,
                 pow(stddev_samp(s) FILTER (s > 0) / avg(s) FILTER (s > 0), 2) AS cv2_raw
          FROM (SELECT u.id, x.date, coalesce(c.n, 0) AS s
                FROM (SELECT DISTINCT 'user_' || user_id AS id FROM events) u
                CROSS JOIN (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date FROM events) x
                LEFT JOIN (SELECT 'user_' || user_id AS id, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2) c
                ON c.id = u.id AND c.date = x.date) GROUP BY id)""")
def _(t):
    return classify.classify_demand(t.activity).select("id", "adi", "cv2", "demand_class")


@query("class_distribution", """
    SELECT demand_class, count(*) AS n_series, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS pct
    FROM classes GROUP BY demand_class""")
def _(t):
    return classify.class_distribution(classify.classify_demand(t.master))


@query("demand_class_counts", """
    SELECT demand_class AS class, count(*) AS count FROM classes WHERE state_id = 'CA' GROUP BY demand_class""")
def _(t):
    return classify.demand_class_counts(t.classes, state_id="CA")


@query("series_by_class", "SELECT id FROM classes WHERE demand_class = 'Smooth'")
def _(t):
    return classify.series_by_class(t.classes, "Smooth")


@query("model_routing", "SELECT model, id, demand_class FROM routing")
def _(t):
    return classify.model_routing(classify.classify_demand(t.master)).select("model", "id", "demand_class")


@query("capped_routing", """
    SELECT model, id, demand_class FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY
        CASE demand_class WHEN 'Smooth' THEN 1 WHEN 'Intermittent' THEN 2 WHEN 'Erratic' THEN 3 ELSE 4 END, id) AS rn
    FROM routing) WHERE rn <= 5""")
def _(t):
    return classify.cap_routing(t.routing, 5).select("model", "id", "demand_class")


@query("model_availability", """
    SELECT c.id, c.demand_class, s.model AS forecast FROM classes c JOIN served s ON s.demand_class = c.demand_class""")
def _(t):
    usable = F.create_map(*[x for k, cols in AVAILABILITY.items() for x in (F.lit(k), F.array(*map(F.lit, cols)))])
    return t.classes.select("id", "demand_class", F.explode(usable[F.col("demand_class")]).alias("forecast"))


# ---- merge, blend ----------------------------------------------------------------------

@query("active_ids", "SELECT id FROM active")
def _(t):
    return active_ids(t.preds)


@query("active_actuals", "SELECT id, date, sales AS actual FROM master WHERE id IN (SELECT id FROM active)")
def _(t):
    return reshape.keep_ids(t.core, active_ids(t.preds)).select("id", "date", F.col("sales").alias("actual"))


@query("prediction_merge", "SELECT * FROM merged")
def _(t):
    return t.merged


_SLOTS = ("lgbm", "prophet", "sarima", "lstm", "dual")


@query("stacked_predictions", " UNION ALL ".join(
    f"SELECT id, date, '{m}' AS model, " + ", ".join(f"{'p.' + c + '_point' if c == m else 'CAST(NULL AS DOUBLE)'} AS {c}_point" for c in _SLOTS)
    + f" FROM pred_{m} p" for m in _SLOTS))
def _(t):
    return reshape.stack([t.preds[f"{m}_point"].select("id", "date", f"{m}_point").withColumn("model", F.lit(m)) for m in _SLOTS]).select(
        "id", "date", "model", *[f"{m}_point" for m in _SLOTS])


@query("blend_gram", "SELECT demand_class, n_rows, x, y, round(value, 2) AS value FROM gram")
def _(t):
    return rounded(t.gram, "value", places=2)


@query("ensemble_weights", "SELECT demand_class, model, weight FROM weights")
def _(t):
    return t.weights


@query("ensemble_point", "SELECT id, date, actual, demand_class, ensemble_point FROM blended")
def _(t):
    return t.blended.select("id", "date", "actual", "demand_class", "ensemble_point")


# ---- scores ----------------------------------------------------------------------------

_ERRORS = """round(sqrt(avg(pow(actual - forecast, 2))), 4) AS rmse, round(avg(abs(actual - forecast)), 4) AS mae,
    round(100 * avg(CASE WHEN abs(actual) + abs(forecast) = 0 THEN 0
        ELSE abs(actual - forecast) / ((abs(actual) + abs(forecast)) / 2) END), 4) AS smape"""


@query("error_metrics", f"""
    SELECT id, {_ERRORS} FROM (SELECT id, sales AS actual, CAST(yday AS DOUBLE) AS forecast FROM lagged WHERE yday IS NOT NULL)
    GROUP BY id""")
def _(t):
    a, p = F.col("sales"), F.col("naive_point").cast("double")
    rows = naive_forecast(t.master).filter(p.isNotNull())
    return rows.groupBy("id").agg(F.round(rmse(a, p), 4).alias("rmse"), F.round(mae(a, p), 4).alias("mae"),
                                  F.round(smape(a, p), 4).alias("smape"))


@query("scaling_factor", """
    SELECT id, round(CASE WHEN avg(s * s) > 0 THEN sqrt(avg(s * s)) ELSE 1 END, 6) AS scale
    FROM (SELECT id, CAST(sales - yday AS DOUBLE) AS s FROM lagged) GROUP BY id""")
def _(t):
    return rounded(scoring.scaling_factor(t.master), "scale")


@query("revenue_weights", """
    SELECT id, round(revenue, 2) AS revenue, round(revenue / ((SELECT sum(revenue) FROM revenue) + 1e-10), 8) AS weight FROM revenue""")
def _(t):
    return rounded(rounded(scoring.revenue_weights(t.master), "revenue", places=2), "weight", places=8)


@query("weight_scale_lookup", """
    SELECT id, round(lgbm_point, 6) AS lgbm_point, round(ensemble_point, 6) AS ensemble_point, round(weight, 2) AS weight FROM rmsse""")
def _(t):
    scored = scoring.series_rmsse(t.blended_recent, t.core, ["lgbm_point", "ensemble_point"])
    return rounded(rounded(scored, "lgbm_point", "ensemble_point"), "weight", places=2)


@query("wrmsse", "SELECT col, round(WRMSSE, 6) AS WRMSSE FROM wrmsse")
def _(t):
    return rounded(scoring.wrmsse(t.blended_recent, t.core, scoring.SCALED_MODELS), "WRMSSE")


@query("wrmsse_covered", " UNION ALL ".join(f"""
    SELECT '{c}' AS col, round(sum(weight * r) / sum(weight), 6) AS WRMSSE FROM (
        SELECT b.id, sqrt(avg(pow(actual - {c}, 2))) / (any_value(scale) + 1e-10) AS r, any_value(revenue) AS weight
        FROM blended b LEFT JOIN scales s ON s.id = b.id LEFT JOIN revenue v ON v.id = b.id
        WHERE date > (SELECT max(date) FROM blended) - 28 GROUP BY b.id) WHERE r IS NOT NULL""" for c in scoring.SCALED_MODELS))
def _(t):
    """Only the series a model has a forecast for."""
    return rounded(scoring.wrmsse(t.blended_recent, t.core, scoring.SCALED_MODELS, covered_only=True), "WRMSSE")


@query("wrmsse_by_level", """
    SELECT level, 'lgbm_point' AS col, round(sum(r * l) / sum(r), 6) AS WRMSSE FROM level_errors GROUP BY level
    UNION ALL SELECT level, 'ensemble_point', round(sum(r * e) / sum(r), 6) FROM level_errors GROUP BY level""")
def _(t):
    return rounded(scoring.wrmsse_by_level(t.blended_recent, t.core, ["lgbm_point", "ensemble_point"]), "WRMSSE")


_COMPARISON = f"""
    SELECT CASE col WHEN 'lgbm_point' THEN 'Lgbm' WHEN 'prophet_point' THEN 'Prophet' WHEN 'sarima_point' THEN 'Sarima'
           WHEN 'lstm_point' THEN 'Lstm' WHEN 'dual_point' THEN 'Dual' ELSE 'Ensemble' END AS model, col, n_series, n_rows,
           rmse AS RMSE, mae AS MAE, smape AS SMAPE, round(w.WRMSSE, 4) AS WRMSSE
    FROM (SELECT model AS col, count(DISTINCT id) AS n_series, count(*) AS n_rows, {_ERRORS} FROM long_preds
          WHERE date > (SELECT max(date) FROM blended) - 28 GROUP BY model) s LEFT JOIN wrmsse w USING (col)"""


@query("model_comparison", _COMPARISON)
def _(t):
    return scoring.model_comparison(t.blended_recent, t.core)


@query("per_class_metrics", f"""
    SELECT demand_class, model, rmse AS RMSE, mae AS MAE, n FROM (
        SELECT demand_class, model, {_ERRORS}, count(*) AS n FROM long_preds GROUP BY demand_class, model)""")
def _(t):
    return scoring.per_class_metrics(t.blended)


@query("model_labels", """
    SELECT DISTINCT model AS col, upper(substr(replace(model, '_point', ''), 1, 1)) || substr(replace(model, '_point', ''), 2) AS label
    FROM long_preds""")
def _(t):
    return (scoring.long_forecasts(t.blended, ["id"], scoring.forecast_columns(t.blended))
            .select(F.col("model").alias("col"), model_label(F.col("model")).alias("label")).distinct())


@query("occurrence_auc", """
    SELECT round((sum(CASE WHEN y = 1 THEN r ELSE 0 END) - p * (p + 1) / 2) / (p * (count(*) - p)), 8) AS auc
    FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r,
                 CAST(sum(y) OVER () AS DOUBLE) AS p
          FROM (SELECT CASE WHEN sales > 0 THEN 1 ELSE 0 END AS y, rolling_nonzero_rate_28 * rolling_mean_28 AS s FROM usable))
    GROUP BY p""")
def _(t):
    scored = t.features.filter(F.col("sales_lag_56").isNotNull()).select(
        (F.col("sales") > 0).cast("int").alias("label"),
        (F.col("rolling_nonzero_rate_28") * F.col("rolling_mean_28")).alias("score"))
    return rounded(scoring.auc(scored), "auc", places=8)


# ---- reports ---------------------------------------------------------------------------

@query("prediction_date_range", "SELECT min(date) AS min_date, max(date) AS max_date FROM blended")
def _(t):
    return serving.prediction_date_range(t.blended)


@query("filter_options", """
    SELECT * FROM (SELECT DISTINCT 'states' AS option, state_id AS value FROM classes
    UNION SELECT 'stores', store_id FROM classes UNION SELECT 'categories', cat_id FROM classes
    UNION SELECT 'demand_classes', unnest(['Smooth', 'Intermittent', 'Erratic', 'Lumpy'])) ORDER BY option, value""")
def _(t):
    return serving.filter_options(t.classes)


@query("filtered_items", """
    SELECT id, demand_class, id || ' (' || demand_class || ')' AS label FROM classes WHERE cat_id = 'CAT_1' ORDER BY id LIMIT 200""")
def _(t):
    return serving.filtered_items(t.classes, cat_id="CAT_1")


@query("series_labels", "SELECT id, id || ' (' || demand_class || ')' AS label FROM classes")
def _(t):
    return t.classes.select("id", series_label(F.col("id"), F.col("demand_class")).alias("label"))


@query("stores_in_state", "SELECT DISTINCT store_id FROM classes WHERE state_id = 'CA' ORDER BY store_id")
def _(t):
    return serving.stores_in_state(t.classes, "CA")


@query("kpi_join", """
    SELECT b.id, b.date, b.actual, b.ensemble_point, l.lgbm_q10, l.lgbm_q90
    FROM blended b LEFT JOIN pred_lgbm l ON l.id = b.id AND l.date = b.date
    WHERE b.date >= (SELECT max(date) FROM blended) - 28""")
def _(t):
    recent = reshape.history_window(t.blended_recent, 28)
    return serving.with_quantiles(recent, t.quantiles).select("id", "date", "actual", "ensemble_point", "lgbm_q10", "lgbm_q90")


def _kpis(only: str = "true") -> str:
    """The KPIs from one row per series of the last 29 dates: sums, and whether it was ever short or over."""
    return f"""
    SELECT * FROM (WITH recent AS (
        SELECT b.id, actual, ensemble_point AS expected, lgbm_q10 AS low, lgbm_q90 AS high
        FROM blended b LEFT JOIN pred_lgbm l USING (id, date)
        WHERE date > (SELECT max(date) - 29 FROM blended) AND {only}),
    by_series AS (
        SELECT id, sum(actual) AS sold, sum(abs(expected - actual)) AS missed, coalesce(bool_or(low = 0 AND expected > 1), false) AS short,
               coalesce(bool_or(expected > 0 AND high > expected * 3), false) AS over
        FROM recent GROUP BY id),
    total AS (SELECT sum(sold) AS sold, sum(missed) AS missed, count(*) FILTER (short) AS short, count(*) FILTER (over) AS over FROM by_series)
    SELECT greatest(round((1 - missed / (sold + 1e-10)) * 100.0::DOUBLE, 1), 0.0::DOUBLE) AS accuracy, short AS stockout_alerts,
           over AS overstock_alerts, CAST(coalesce(sold, 0) AS BIGINT) AS total_sales, short * 150 AS revenue_at_risk
    FROM total)"""


@query("overview_kpis", _kpis())
def _(t):
    return serving.overview_kpis(t.blended_recent, t.classes, t.quantiles)


@query("overview_kpis_filtered", _kpis("b.id IN (SELECT id FROM classes WHERE state_id = 'TX' AND cat_id = 'CAT_0')"))
def _(t):
    return serving.overview_kpis(t.blended_recent, t.classes, t.quantiles, state_id="TX", cat_id="CAT_0")


@query("weekly_trend", """
    SELECT CAST(date_trunc('week', date) AS DATE) AS date, CAST(sum(actual) AS BIGINT) AS actual, round(sum(ensemble_point), 3) AS forecast
    FROM blended WHERE id IN (SELECT id FROM classes WHERE store_id = 'ASIA') GROUP BY 1 ORDER BY 1""")
def _(t):
    return rounded(serving.weekly_trend(t.blended, t.classes, store_id="ASIA"), "forecast", places=3)


_SLICE = ("PROMO_ALL", "2000-01-01", "2001-06-30")


@query("forecast_slice", """
    SELECT b.date, actual, b.lgbm_point, prophet_point, sarima_point, lstm_point, dual_point, ensemble_point, lgbm_q10, lgbm_q90
    FROM blended b LEFT JOIN pred_lgbm l ON l.id = b.id AND l.date = b.date
    WHERE b.id = 'PROMO_ALL' AND b.date BETWEEN DATE '2000-01-01' AND DATE '2001-06-30' ORDER BY b.date""")
def _(t):
    return serving.forecast_slice(t.blended_series(*_SLICE), t.quantiles, *_SLICE)


@query("series_badges", """
    SELECT round(avg(abs(actual - ensemble_point)), 2) AS MAE, round(sqrt(avg(pow(actual - ensemble_point, 2))), 2) AS RMSE
    FROM blended WHERE id = 'PROMO_ALL' AND date BETWEEN DATE '2000-01-01' AND DATE '2001-06-30'""")
def _(t):
    return serving.series_badges(t.blended_series(*_SLICE), *_SLICE)


_COVERAGE = """
    SELECT m.model, coalesce(n_rows, 0) AS n_rows, coalesce(n_series, 0) AS n_series, coalesce(want, 0) AS expected_series,
           CASE WHEN n_rows IS NULL THEN 'missing' WHEN n_series >= coalesce(want, 0) THEN 'complete' ELSE 'partial' END AS state
    FROM (SELECT unnest(['sarima', 'prophet', 'lgbm', 'lstm', 'dual_phase']) AS model) m
    LEFT JOIN (SELECT 'lgbm' AS model, count(*) AS n_rows, count(DISTINCT id) AS n_series FROM pred_lgbm
               UNION ALL SELECT 'prophet', count(*), count(DISTINCT id) FROM pred_prophet
               UNION ALL SELECT 'sarima', count(*), count(DISTINCT id) FROM pred_sarima
               UNION ALL SELECT 'lstm', count(*), count(DISTINCT id) FROM pred_lstm
               UNION ALL SELECT 'dual_phase', count(*), count(DISTINCT id) FROM pred_dual) g ON g.model = m.model
    LEFT JOIN (SELECT model, count(*) AS want FROM routing GROUP BY model) r ON r.model = m.model"""


def _coverage(t):
    return serving.prediction_coverage({c.removesuffix("_point"): p for c, p in t.preds.items()}, t.routing)


@query("prediction_coverage", _COVERAGE)
def _(t):
    return _coverage(t)


@query("incomplete_models", f"SELECT model FROM ({_COVERAGE}) WHERE state <> 'complete'")
def _(t):
    return serving.incomplete_models(_coverage(t))


@query("risk_grid", """
    SELECT b.id, b.date, CASE WHEN lgbm_q10 = 0 AND ensemble_point > 1 THEN 'red'
           WHEN lgbm_q90 > 3 * ensemble_point AND ensemble_point > 0 THEN 'amber' ELSE 'green' END AS risk
    FROM blended b LEFT JOIN pred_lgbm l ON l.id = b.id AND l.date = b.date
    WHERE b.date >= (SELECT max(date) FROM blended) - 28""")
def _(t):
    return serving.risk_grid(t.blended_recent, t.quantiles)


@query("kpi_change", """
    SELECT greatest(0.0::DOUBLE, round(100.0::DOUBLE * (1 - sum(abs(actual - ensemble_point)) FILTER (now) / (sum(actual) FILTER (now) + 1e-10)), 1)) AS accuracy,
           greatest(0.0::DOUBLE, round(100.0::DOUBLE * (1 - sum(abs(actual - ensemble_point)) FILTER (NOT now) / (sum(actual) FILTER (NOT now) + 1e-10)), 1)) AS accuracy_before,
           CAST(sum(actual) FILTER (now) AS BIGINT) AS total_sales, CAST(sum(actual) FILTER (NOT now) AS BIGINT) AS total_sales_before
    FROM (SELECT *, date >= (SELECT max(date) FROM blended) - 28 AS now FROM blended WHERE date >= (SELECT max(date) FROM blended) - 57)""")
def _(t):
    return serving.kpi_change(t.blended_recent)


# ---- forecasts -------------------------------------------------------------------------

@query("holiday_windows", 'SELECT date, holiday, "offset" FROM holiday_days')
def _(t):
    return decompose.expand_holidays(decompose.holiday_days(t.raw.calendar))


_POINTS = "prophet_point, prophet_lower, prophet_upper"
_POINT_COLS = ["prophet_point", "prophet_lower", "prophet_upper"]


@query("decompose_forecast", f"SELECT id, date, {_POINTS} FROM decomposed WHERE NOT ahead_of_data")
def _(t):
    fitted = decompose.decompose(t.panel, decompose.holiday_days(t.panel))
    return rounded(fitted.select("id", "date", *_POINT_COLS), *_POINT_COLS, places=4)


@query("decompose_ahead", f"SELECT id, date, {_POINTS}, trend FROM decomposed WHERE ahead_of_data")
def _(t):
    ahead = decompose.decompose(t.panel, decompose.holiday_days(t.panel), horizon=28)
    return rounded(ahead, *_POINT_COLS, "trend", places=4)


@query("trend_component", "SELECT id, date, trend FROM decomposed")
def _(t):
    days = decompose.holiday_days(t.panel)
    both = decompose.decompose(t.panel, days).unionByName(decompose.decompose(t.panel, days, horizon=28))
    return rounded(both.select("id", "date", "trend"), "trend", places=4)


@query("future_dates", """
    SELECT id, CAST(unnest(generate_series(max(date) + 1, max(date) + 28, INTERVAL 1 DAY)) AS DATE) AS date FROM panel GROUP BY id""")
def _(t):
    return decompose.future_dates(t.raw_panel, 28)


@query("seasonal_ar", """
    SELECT id, date, round(greatest(coalesce(before, 0) + coalesce(a, 0) * wa + coalesce(b, 0) * wb + coalesce(c, 0) * wc, 0), 4) AS sarima_point
    FROM steps JOIN ar_fit USING (id)""")
def _(t):
    return rounded(seasonal_arima.seasonal_arima(t.panel, order=(1, 1, 0), seasonal=(1, 0, 0, 7)), "sarima_point", places=4)


@query("seasonal_difference_ar", """
    SELECT id, date, round(greatest(coalesce(before, 0) + coalesce(a, 0) * wa, 0), 4) AS sarima_point
    FROM week_steps JOIN (SELECT id, sum(w * a) / sum(a * a) AS wa FROM week_steps WHERE rn >= 9 GROUP BY id) USING (id)""")
def _(t):
    return rounded(seasonal_arima.seasonal_arima(t.panel, order=(1, 0, 0), seasonal=(0, 1, 0, 7)), "sarima_point", places=4)


@query("seasonal_difference_ahead", """
    SELECT id, hi + CAST(k AS INTEGER) AS date, greatest(point, 0) AS sarima_point,
           round(greatest(point - spread, 0), 4) AS sarima_lower, round(greatest(point + spread, 0), 4) AS sarima_upper
    FROM (SELECT id, max(date) AS hi, k, CAST(max(sales) FILTER (rn = n) + max(sales) FILTER (rn = n + k - 7) - max(sales) FILTER (rn = n - 7) AS DOUBLE) AS point,
                 1.959964 * sqrt(k * sum(w * w) / count(w)) AS spread
          FROM both_steps, (SELECT unnest(range(1, 8)) AS k) GROUP BY id, k)""")
def _(t):
    """A plain and a weekly difference without weights: the bounds of a week grow with the root of the days."""
    ahead = seasonal_arima.seasonal_arima_forecast(t.panel, horizon=7, order=(0, 1, 0), seasonal=(0, 1, 0, 7))
    return rounded(ahead, "sarima_lower", "sarima_upper", places=4)


@query("seasonal_arima")
def _(t):
    return seasonal_arima.seasonal_arima(t.panel)


@query("seasonal_arima_ahead")
def _(t):
    return seasonal_arima.seasonal_arima_forecast(t.panel)


@query("difference_orders", """
    SELECT * FROM (WITH valued AS (
        SELECT id, date, CAST(sales AS DOUBLE) AS y, row_number() OVER w AS rn, count(*) OVER (PARTITION BY id) AS n
        FROM panel WHERE sales IS NOT NULL WINDOW w AS (PARTITION BY id ORDER BY date)),
    detrended AS (
        SELECT *, CASE WHEN count(y) OVER a = 7 THEN y - avg(y) OVER a END AS free
        FROM valued WHERE n >= 60 WINDOW a AS (PARTITION BY id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    weekly AS (SELECT *, free - avg(free) OVER (PARTITION BY id, rn % 7) AS rest FROM detrended),
    strengths AS (
        SELECT id, CASE WHEN var_pop(free) > 0 THEN greatest(0, 1 - var_pop(rest) / var_pop(free)) ELSE 0 END AS strength
        FROM weekly GROUP BY id),
    s0 AS (
        SELECT id, date, rn, n, strength, CASE WHEN strength >= 0.64 THEN y - lag(y, 7) OVER w ELSE y END AS v
        FROM valued JOIN strengths USING (id) WINDOW w AS (PARTITION BY id ORDER BY date)),
    steps_of AS (
        SELECT *, 0 AS d FROM s0 UNION ALL
        SELECT id, date, rn, n, strength, v - lag(v) OVER (PARTITION BY id ORDER BY date) AS v, 1 AS d FROM s0),
    centred AS (
        SELECT id, d, n, strength, row_number() OVER w AS t, count(*) OVER (PARTITION BY id, d) AS m,
               v - avg(v) OVER (PARTITION BY id, d) AS e
        FROM steps_of WHERE v IS NOT NULL WINDOW w AS (PARTITION BY id, d ORDER BY date)),
    lagged AS (
        SELECT a.id, a.d, k, sum(a.e * b.e) AS c
        FROM centred a, (SELECT unnest(generate_series(0, 14)) AS k), centred b
        WHERE a.id = b.id AND a.d = b.d AND b.t = a.t - k GROUP BY ALL),
    spreads AS (SELECT id, d, sum(CASE WHEN k = 0 THEN c ELSE 2 * (1 - k / 15.0) * c END) AS spread FROM lagged GROUP BY id, d),
    runs AS (SELECT id, d, n, strength, m, sum(e) OVER (PARTITION BY id, d ORDER BY t) AS run FROM centred),
    levels AS (
        SELECT id, d, any_value(n) AS n, any_value(strength) AS strength,
               CASE WHEN any_value(spread) > 0 THEN sum(run * run) / (any_value(m) * any_value(spread)) ELSE 0 END AS stat
        FROM runs JOIN spreads USING (id, d) GROUP BY id, d),
    tested AS (
        SELECT id, any_value(n) AS n, any_value(strength) AS strength, max(stat) FILTER (d = 0) AS level_0,
               max(stat) FILTER (d = 1) AS level_1
        FROM levels GROUP BY id)
    SELECT id, n, round(CAST(strength AS DOUBLE), 6) AS strength, CAST(strength >= 0.64 AS INTEGER) AS seasonal,
           round(level_0, 6) AS level_0, round(level_1, 6) AS level_1,
           CAST(CASE WHEN level_0 <= 0.463 THEN 0 WHEN level_1 <= 0.463 THEN 1 ELSE 2 END AS INTEGER) AS plain
    FROM tested)""")
def _(t):
    return rounded(seasonal_arima.difference_orders(t.panel), "strength", "level_0", "level_1")


@query("searched_arima")
def _(t):
    return seasonal_arima.searched_arima(t.panel)


@query("order_search")
def _(t):
    return seasonal_arima.order_search(t.panel)


@query("quantile_levels", """
    SELECT store_id, day_of_week, quantile_cont(sales, 0.1) AS q10, quantile_cont(sales, 0.5) AS q50, quantile_cont(sales, 0.9) AS q90
    FROM usable GROUP BY store_id, day_of_week""")
def _(t):
    usable = features.add_lags(features.add_calendar(t.master)).filter(F.col("sales_lag_56").isNotNull())
    return boosted.leaf_quantiles(usable, ["store_id", "day_of_week"])


@query("boosted_point")
def _(t):
    model = boosted.fit_boosted(t.staged_features, quantiles=None)
    return boosted.predict_boosted(model, t.staged_features)


@query("quantile_band")
def _(t):
    """Three quantiles, each from its own loss."""
    model = boosted.fit_boosted(t.staged_features)
    return boosted.predict_boosted(model, t.staged_features).drop("lgbm_point")


@query("feature_importance")
def _(t):
    model = boosted.fit_boosted(t.staged_features, quantiles=None)
    return boosted.feature_importance(model, t.staged_features, 20)


@query("dual_forecast")
def _(t):
    """Chance, size and product for the series routed to the two-part model."""
    ids = t.routing.filter(F.col("model") == "dual_phase")
    model = dual.fit_dual(t.staged_features, ids)
    return dual.predict_dual(model, t.staged_features, ids)


@query("dual_product", """
    SELECT id, date, round(least(rolling_nonzero_rate_28, 1), 4) AS dual_occurrence_prob, round(rolling_mean_28, 3) AS dual_magnitude,
           round(least(rolling_nonzero_rate_28, 1) * rolling_mean_28, 3) AS dual_point FROM usable""")
def _(t):
    """The operator's product and rounding, on a chance and a size that need no fit."""
    return dual.product(t.features.filter(F.col("sales_lag_56").isNotNull()), F.col("rolling_nonzero_rate_28"), F.col("rolling_mean_28"))


@query("scaling_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM usable" for c in sequence.SEQUENCE_COLS))
def _(t):
    usable = t.features.filter(F.col("sales_lag_56").isNotNull())
    return rounded(sequence.scaling_stats(usable, sequence.SEQUENCE_COLS), "mean", "std")


@query("sequence_windows", """
    SELECT id, date, target, CAST(56 AS INTEGER) AS size, CAST(total AS DOUBLE) AS total, CAST(oldest AS DOUBLE) AS oldest
    FROM (SELECT id, date, CAST(sales AS DOUBLE) AS target, row_number() OVER w AS rn,
                 sum(sales_lag_7 + day_of_week) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS total,
                 lag(sales_lag_7, 28) OVER w AS oldest
          FROM usable WINDOW w AS (PARTITION BY id ORDER BY date)) WHERE rn > 28 AND (rn - 29) % 7 = 0""")
def _(t):
    usable = features.add_calendar(features.add_lags(t.master)).filter(F.col("sales_lag_56").isNotNull())
    windows = sequence.sequence_windows(usable, ["sales_lag_7", "day_of_week"], stride=7)
    return windows.select("id", "date", "target", F.size("window").alias("size"),
                          F.aggregate("window", F.lit(0.0), lambda a, v: a + v).alias("total"), F.col("window")[0].alias("oldest"))


@query("sequence_forecast")
def _(t):
    model = sequence.fit_sequence(t.staged_features)
    return sequence.predict_sequence(model, t.staged_features)


@query("fitted_model_comparison")
def _(t):
    """All five fitted models on their routed series, blended and scored."""
    preds = jobs.fit_and_predict(t.staged_features, t.panel, t.classes)
    return jobs.blend_and_score(t.master, preds, t.classes)[1]


# ---- what every fitted model promises, whatever its digits --------------------------------

def _contract(preds: DataFrame, point: str, *ordered: str) -> DataFrame:
    """Rows, series, days, and how many rows break a rule: absent or negative points, levels out of order."""
    broken = F.col(point).isNull() | (F.col(point) < 0)
    for low, high in zip(ordered, ordered[1:]):
        broken = broken | (F.col(low) > F.col(high))
    return preds.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_series"), F.min("date").alias("first_day"),
                     F.max("date").alias("last_day"), F.count(F.when(broken, True)).alias("broken"))


def _promise(source: str) -> str:
    return f"""SELECT count(*) AS n_rows, count(DISTINCT id) AS n_series, min(date) AS first_day, max(date) AS last_day,
                      CAST(0 AS BIGINT) AS broken FROM {source}"""


@query("boosted_contract", _promise("usable").replace("FROM", ", true AS several_trees, true AS beats_last_week, true AS beats_constant FROM", 1))
def _(t):
    """Also: more than one tree, and a lower validation error than last week's sales and than any constant."""
    model = boosted.fit_boosted(t.staged_features, quantiles=None)
    preds = stage(boosted.predict_boosted(model, t.staged_features), "boosted")
    held = scoring.last_days(t.staged_features.select("id", "date", "sales", "sales_lag_7"), 28).join(preds, ["id", "date"])
    middle = held.agg(F.percentile("sales", 0.5)).scalar()
    miss = [F.avg(F.abs(F.col("sales") - c)) for c in (F.col("lgbm_point"), F.col("sales_lag_7"), F.col("middle"))]
    flags = held.withColumn("middle", middle).agg((miss[0] < miss[1]).alias("beats_last_week"), (miss[0] < miss[2]).alias("beats_constant")).first()
    return _contract(preds, "lgbm_point").withColumns({"several_trees": F.lit(len(model.forest.trees[0]) > 1), **{k: F.lit(v) for k, v in flags.asDict().items()}})


@query("quantile_band_contract", _promise("usable").replace("FROM", ", true AS covers FROM", 1))
def _(t):
    """Also: on the validation days the band from the first to the ninth decile covers 80 % of the rows, give or take what ties of whole numbers add."""
    model = boosted.fit_boosted(t.staged_features)
    preds = stage(boosted.predict_boosted(model, t.staged_features), "band")
    held = scoring.last_days(t.staged_features.select("id", "date", "sales"), 28).join(preds, ["id", "date"])
    below = held.agg(F.avg((F.col("sales") < F.floor("lgbm_q10")).cast("double")), F.avg((F.col("sales") > F.ceil("lgbm_q90")).cast("double"))).first()
    return _contract(preds, "lgbm_q50", "lgbm_q10", "lgbm_q50", "lgbm_q90").withColumn("covers", F.lit(max(below) < 0.13))


@query("sequence_contract", _promise("(SELECT id, date FROM usable QUALIFY row_number() OVER (PARTITION BY id ORDER BY date) > 28)"))
def _(t):
    model = sequence.fit_sequence(t.staged_features)
    return _contract(sequence.predict_sequence(model, t.staged_features), "lstm_point")


@query("seasonal_arima_contract", _promise("panel"))
def _(t):
    return _contract(seasonal_arima.seasonal_arima(t.panel), "sarima_point")


@query("seasonal_arima_ahead_contract", _promise("""
    (SELECT DISTINCT id, hi + CAST(k AS INTEGER) AS date FROM panel, bounds, (SELECT unnest(range(1, 29)) AS k))"""))
def _(t):
    return _contract(seasonal_arima.seasonal_arima_forecast(t.panel), "sarima_point", "sarima_lower", "sarima_point", "sarima_upper")


@query("order_search_contract", """
    SELECT CAST(9 AS BIGINT) AS n_orders, CAST(1 AS BIGINT) AS n_best, true AS best_is_least,
           CAST((SELECT count(DISTINCT id) FROM panel) AS BIGINT) AS n_series""")
def _(t):
    found = stage(seasonal_arima.order_search(t.panel), "orders")
    least = found.agg(F.min("mean_aic")).scalar()
    return found.agg(F.count(F.lit(1)).alias("n_orders"), F.count(F.when(F.col("best"), True)).alias("n_best"),
                     F.max(F.when(F.col("best"), F.col("mean_aic") == least)).alias("best_is_least"), F.max("n_series").alias("n_series"))


# ---- files and tables ------------------------------------------------------------------

@query("csv_ingest", "SELECT * FROM master")
def _(t):
    """All series written as raw files (one column per day), then read and built again."""
    folder = new_path(t.spark, "raw_files")
    raw_files.write_raw(folder, t.raw.sales, t.raw.calendar, t.raw.prices)
    return jobs.master_from_files(t.spark, folder)


@query("melt_wide_sales", "SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, sales FROM panel")
def _(t):
    return reshape.melt_sales(raw_files.widen(t.raw.sales))


def _store(t) -> TableStore:
    return TableStore(t.spark, new_path(t.spark, "tables"))


@query("table_replace", "SELECT * FROM classes")
def _(t):
    """Written twice, then with no rows, which keeps the table."""
    store = _store(t)
    store.replace("demand_classes", t.classes.limit(1))
    store.replace("demand_classes", t.classes)
    store.replace("demand_classes", t.classes.filter(F.lit(False)))
    return store.read("demand_classes")


@query("table_append", "SELECT id, demand_class FROM classes")
def _(t):
    store = _store(t)
    kept = t.classes.select("id", "demand_class")
    store.replace("some", kept.filter(F.col("id").endswith("_ALL")))
    store.append("some", kept.filter(~F.col("id").endswith("_ALL")).select("demand_class", "id"))
    return store.read("some")


@query("table_cached", "SELECT id, date, sales FROM master")
def _(t):
    """The second call reads the stored table."""
    store = _store(t)
    store.cached("panel", lambda: t.raw_panel)
    return store.cached("panel", lambda: t.raw_panel.limit(0))


@query("report_sink", _COMPARISON)
def _(t):
    path = _store(t).report("model_comparison", scoring.model_comparison(t.blended_recent, t.core))
    return t.spark.read.option("header", True).schema(
        "model string, col string, n_series bigint, n_rows bigint, RMSE double, MAE double, SMAPE double, WRMSSE double").csv(path)


@query("weights_round_trip", "SELECT demand_class, model, weight FROM weights")
def _(t):
    store = _store(t)
    store.replace("blend_weights", t.weights)
    return store.read("blend_weights")

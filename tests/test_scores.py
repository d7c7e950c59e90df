import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.errors import mae, rmse, smape
from shelfcast.operators import blend, boosted, scoring, serving

DAY = dt.date(2020, 1, 1)


def score(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, p double")
    a, p = F.col("a"), F.col("p")
    return df.agg(rmse(a, p).alias("rmse"), mae(a, p).alias("mae"), smape(a, p).alias("smape")).first()


def test_errors(spark):
    assert tuple(score(spark, [(float(i), float(i)) for i in range(1, 6)])) == (0, 0, 0)
    assert score(spark, [(3.0, 5.0)] * 4)["rmse"] == 2.0
    assert score(spark, [(0.0, 0.0)] * 2)["smape"] == 0.0
    assert score(spark, [(0.0, 2.0), (1.0, 1.0)])["smape"] == 100.0


def test_scale_of_flat_and_short_series(series):
    scales = {r["id"]: r["scale"] for r in scoring.scaling_factor(series({"flat": [2] * 5, "one": [3], "up": [0, 3, 7]})).collect()}
    assert scales["flat"] == 1.0 and scales["one"] == 1.0
    assert scales["up"] == pytest.approx((12.5) ** 0.5)


def preds_of(master, **cols):
    return master.select("id", "date", F.col("sales").alias("actual"), *[v.alias(k) for k, v in cols.items()])


def test_wrmsse_missing_forecast_counts_as_zero(series):
    master = series({"a": [1, 3] * 50, "b": [4, 4] * 50})
    preds = preds_of(master, lgbm_point=F.when(F.col("id") == "a", F.lit(2.0)))
    got = scoring.wrmsse(preds, master, ["lgbm_point"], 28).first()["WRMSSE"]
    # a: error 1, scale 2; b: error 4, scale 1 (flat); revenue over the 29 dates to max - 28.
    sold = {"a": sum([1, 3][i % 2] for i in range(43, 72)), "b": 4 * 29}
    want = (sold["a"] * 0.5 + sold["b"] * 4.0) / sum(sold.values())
    assert got == pytest.approx(want, rel=1e-9)


def test_wrmsse_equal_weights_without_revenue(series):
    master = series({"a": [1, 3] * 50, "b": [4, 4] * 50}).withColumn("sell_price", F.lit(0.0))
    preds = preds_of(master, lgbm_point=F.lit(2.0))
    assert scoring.wrmsse(preds, master, ["lgbm_point"], 28).first()["WRMSSE"] == pytest.approx((0.5 + 2.0) / 2)


def test_wrmsse_covered_has_a_row_for_a_model_without_forecasts(series):
    master = series({"a": [1, 3] * 50})
    preds = preds_of(master, lgbm_point=F.lit(2.0), dual_point=F.lit(None).cast("double"))
    got = {r["col"]: r["WRMSSE"] for r in scoring.wrmsse(preds, master, ["lgbm_point", "dual_point"], covered_only=True).collect()}
    assert got == {"lgbm_point": pytest.approx(0.5), "dual_point": None}


def test_comparison_shape(series):
    master = series({"a": [1, 3] * 50})
    table = scoring.model_comparison(preds_of(master, lgbm_point=F.lit(2.0), sarima_point=F.lit(None).cast("double"),
                                              lstm_point=F.lit(1.0)), master)
    rows = {r["col"]: r for r in table.collect()}
    assert set(rows) == {"lgbm_point", "lstm_point"}
    assert rows["lgbm_point"]["model"] == "Lgbm" and rows["lgbm_point"]["n_rows"] == 28
    assert rows["lstm_point"]["WRMSSE"] is None


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + (p == n) / 2 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))


@pytest.mark.parametrize("scores", [lambda r: r.random(), lambda r: r.choice([0.1, 0.2, 0.2, 0.9]),
                                    lambda r: 0.5 if r.random() < 0.4 else r.random() * 1e-6])
def test_auc_is_exact(spark, scores):
    r = random.Random(3)
    pairs = [(scores(r), int(r.random() < 0.3)) for _ in range(700)]
    got = scoring.auc(spark.createDataFrame(pairs, "score double, label int")).first()["auc"]
    assert got == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_of_one_label_is_null(spark):
    assert scoring.auc(spark.createDataFrame([(0.1, 1), (0.4, 1)], "score double, label int")).first()["auc"] is None


@pytest.mark.parametrize("seed", range(8))
def test_nonnegative_ridge_beats_a_grid(seed):
    rng = np.random.default_rng(seed)
    n = 2 if seed < 3 else 4
    base = rng.normal(size=(200, 1))
    x = base + 0.3 * rng.normal(size=(200, n))
    y = x @ rng.uniform(-1, 1, n) + rng.normal(size=200)
    gram, target = x.T @ x, x.T @ y
    w = blend.nonnegative_ridge(gram, target, 1.0)

    def loss(v):
        return v @ (gram + np.eye(n)) @ v - 2 * target @ v

    assert (w >= 0).all()
    for step in np.vstack([np.eye(n), -np.eye(n), rng.normal(size=(200, n))]):
        for size in (1e-3, 1e-1):
            assert loss(w) <= loss(np.maximum(w + size * step, 0)) + 1e-9


def merged_frame(spark, rows):
    return spark.createDataFrame(rows, "id string, date date, actual double, lgbm_point double, dual_point double, demand_class string")


def test_weights_and_fallback(spark):
    r = random.Random(1)
    rows = []
    for i in range(150):
        a, b = r.uniform(1, 5), r.uniform(1, 5)
        rows.append(("x", DAY + dt.timedelta(days=i % 50), 0.7 * a + 0.3 * b, a, b, "Lumpy"))
    rows += [("y", DAY + dt.timedelta(days=i), 1.0, 2.34567, 5.0, "Intermittent") for i in range(50)]
    rows += [("z", DAY, 1.0, -1.0, 5.0, None), ("s", DAY, 1.0, -1.0, 5.0, "Smooth")]
    merged = merged_frame(spark, rows)
    weights = blend.ensemble_weights(blend.blend_gram(merged))
    got = {(r["demand_class"], r["model"]): r["weight"] for r in weights.collect()}
    assert set(k for k, _ in got) == {"Lumpy"}  # fewer than 100 rows elsewhere
    assert got["Lumpy", "lgbm_point"] == pytest.approx(0.7, abs=0.01)
    out = blend.apply_blend(merged, weights)
    assert out.filter("id = 'z'").count() == 0
    assert {r["ensemble_point"] for r in out.filter("id = 'y'").collect()} == {2.34567}
    assert out.filter("id = 's'").first()["ensemble_point"] == 0.0
    row = out.filter("id = 'x'").first()
    want = (row["lgbm_point"] * got["Lumpy", "lgbm_point"] + row["dual_point"] * got["Lumpy", "dual_point"])
    assert row["ensemble_point"] == pytest.approx(want, abs=2e-3)


def test_missing_forecast_blends_as_zero(spark):
    merged = merged_frame(spark, [("x", DAY, 1.0, None, 4.0, "Lumpy")])
    weights = spark.createDataFrame([("Lumpy", "lgbm_point", 0.25), ("Lumpy", "dual_point", 0.75)], "demand_class string, model string, weight double")
    assert blend.apply_blend(merged, weights).first()["ensemble_point"] == 3.0


def test_a_half_thousandth_goes_up(spark):
    """2661 x 0.9831 + 2644 x 0.0161 + 2745 x 0.0008 is 2660.7935, in doubles one bit less."""
    merged = spark.createDataFrame([("x", DAY, 2600.0, 2661.0, 2644.0, 2745.0, 2591.429, "Smooth")],
                                   "id string, date date, actual double, lgbm_point double, prophet_point double, sarima_point double, lstm_point double, demand_class string")
    shares = {"lgbm_point": 0.9831, "prophet_point": 0.0161, "sarima_point": 0.0008, "lstm_point": 0.0}
    weights = spark.createDataFrame([("Smooth", m, w) for m, w in shares.items()], "demand_class string, model string, weight double")
    assert blend.apply_blend(merged, weights).first()["ensemble_point"] == 2660.794


def test_weights_all_zero_give_zero(spark):
    merged = merged_frame(spark, [("x", DAY, 1.0, 2.0, 4.0, "Lumpy")])
    weights = spark.createDataFrame([("Lumpy", "lgbm_point", 0.0), ("Lumpy", "dual_point", 0.0)], "demand_class string, model string, weight double")
    assert blend.apply_blend(merged, weights).first()["ensemble_point"] == 0.0


def test_merge_keeps_active_series_only(spark, series):
    master = series({"a": [1, 2], "b": [3, 4], "c": [5, 6]})
    preds = {"lgbm_point": master.filter("id = 'a'").select("id", "date", F.lit(1.5).alias("lgbm_point")),
             "dual_point": master.filter("id = 'b'").select("id", "date", F.lit(2.5).alias("dual_point"))}
    classes = spark.createDataFrame([("a", "Smooth")], "id string, demand_class string")
    rows = blend.merge_predictions(master, preds, classes).collect()
    assert {(r["id"], r["lgbm_point"], r["dual_point"], r["demand_class"]) for r in rows} == {
        ("a", 1.5, None, "Smooth"), ("b", None, 2.5, None)}


def kpi_inputs(spark, days=40):
    rows = [("a", DAY + dt.timedelta(days=i), 10, 8.0) for i in range(days)]
    preds = spark.createDataFrame(rows, "id string, date date, actual bigint, ensemble_point double")
    bands = preds.select("id", "date", F.lit(0.0).alias("lgbm_q10"), F.lit(30.0).alias("lgbm_q90"))
    classes = spark.createDataFrame([("a", "CA", "s", "c")], "id string, state_id string, store_id string, cat_id string")
    return preds, classes, bands


def test_kpis_cover_29_dates(spark):
    row = serving.overview_kpis(*kpi_inputs(spark)).first()
    assert row["total_sales"] == 290 and row["accuracy"] == 80.0
    assert (row["stockout_alerts"], row["overstock_alerts"], row["revenue_at_risk"]) == (1, 1, 150)


def test_kpis_of_nothing(spark):
    row = serving.overview_kpis(*kpi_inputs(spark), state_id="WI").first()
    assert row["accuracy"] is None and row["total_sales"] == 0 and row["stockout_alerts"] == 0


def test_kpi_change_compares_equal_windows(spark):
    row = serving.kpi_change(kpi_inputs(spark, 80)[0]).first()
    assert row["total_sales"] == row["total_sales_before"] == 290


def test_coverage_states(spark):
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "id string")
    routing = spark.createDataFrame([("lgbm", "a"), ("lgbm", "b"), ("sarima", "a"), ("dual_phase", "b")], "model string, id string")
    table = serving.prediction_coverage({"lgbm": ids("a", "a"), "dual": ids("b")}, routing)
    assert {r["model"]: r["state"] for r in table.collect()} == {
        "lgbm": "partial", "dual_phase": "complete", "sarima": "missing", "prophet": "missing", "lstm": "missing"}
    assert {r["model"] for r in serving.incomplete_models(table).collect()} == {"lgbm", "sarima", "prophet", "lstm"}


def test_leaf_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 40, 500)
    df = spark.createDataFrame([(int(v),) for v in values], "sales int").withColumn("leaf", F.lit(1))
    row = boosted.leaf_quantiles(df, ["leaf"]).first()
    assert [row["q10"], row["q50"], row["q90"]] == pytest.approx(np.quantile(values, [0.1, 0.5, 0.9]))

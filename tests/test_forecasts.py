import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.calendar import easter
from shelfcast.operators import boosted, decompose, dual, seasonal_arima, sequence
from shelfcast.operators.features import build_features
from shelfcast.operators.reshape import build_master
from shelfcast.plans import jobs
from shelfcast.sources.store import TableStore

DENSE, SPARSE = "busy_shop", "slow_shop"
FIRST, DAYS = dt.date(2018, 10, 8), 260
LATE = FIRST + dt.timedelta(days=190)


def sales_of(name: str, i: int, price: float, noise: random.Random) -> int:
    """Busy: growth, a weekly and a yearly wave, more at a lower price.  Slow: a sale on three of eleven days."""
    day = FIRST + dt.timedelta(days=i)
    if name == DENSE:
        wave = 9 * math.sin(2 * math.pi * day.weekday() / 7) + 4 * math.cos(2 * math.pi * day.timetuple().tm_yday / 365)
        return round(31 + i / 26 + wave + 12 * (4.5 - price) + noise.uniform(-2, 2))
    return 6 + i % 4 if i % 11 in (1, 4, 8) else 0


@pytest.fixture(scope="module")
def master(spark):
    """Two series of 260 days with prices that move every five weeks and a fair in spring."""
    noise = random.Random(17)
    calendar, sales, prices = [], [], {}
    for i in range(DAYS):
        day, week = FIRST + dt.timedelta(days=i), 900 + i // 7
        fair = ("Fair", "Cultural") if (day.month, day.day) == (4, 13) else (None, None)
        calendar.append((day, f"d_{i + 1}", week, day.strftime("%A"), *fair, None, None, int(i % 5 == 1), int(day.day > 24), int(i % 3 == 0)))
        for name in (DENSE, SPARSE):
            prices[name, week] = 4.5 - 0.25 * (i // 35 % 3)
            sales.append((name, name, "dep", "cat", "north", "TX", f"d_{i + 1}", sales_of(name, i, prices[name, week], noise)))
    days = spark.createDataFrame(calendar, "date date, d string, wm_yr_wk int, weekday string, event_name_1 string, event_type_1 string,"
                                           "event_name_2 string, event_type_2 string, snap_CA int, snap_TX int, snap_WI int")
    long = spark.createDataFrame(sales, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, sales bigint")
    paid = spark.createDataFrame([("north", n, w, p) for (n, w), p in prices.items()], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    return build_master(long, days, paid).persist()


@pytest.fixture(scope="module")
def features(master):
    return build_features(master).persist()


def error(master, preds, column, name):
    rows = preds.join(master.select("id", "date", "sales"), ["id", "date"]).filter(F.col("id") == name)
    rows = rows.filter(F.col("date") > LATE)
    return rows.agg(F.avg(F.abs(F.col("sales") - F.col(column)))).first()[0]


def naive_error(master, name, k=1):
    from pyspark.sql import Window
    lagged = master.select("id", "date", "sales", F.lag("sales", k).over(Window.partitionBy("id").orderBy("date")).alias("p"))
    return lagged.filter((F.col("id") == name) & (F.col("date") > LATE)).agg(F.avg(F.abs(F.col("sales") - F.col("p")))).first()[0]


def test_boosted(spark, master, features, tmp_path):
    model = boosted.fit_boosted(features, val_days=20, rounds=120, patience=30, leaves=8)
    preds = boosted.predict_boosted(model, features).persist()
    assert preds.columns == ["id", "date", "lgbm_point", "lgbm_q10", "lgbm_q50", "lgbm_q90"]
    assert preds.count() == 2 * (DAYS - 56)
    assert preds.filter("lgbm_point < 0 or lgbm_q10 > lgbm_q50 or lgbm_q50 > lgbm_q90 or lgbm_q10 is null").isEmpty()
    assert error(master, preds, "lgbm_point", DENSE) < naive_error(master, DENSE)
    top = boosted.feature_importance(model, features, 5, val_days=20).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"] and top[0]["importance"] > 0
    model.save(str(tmp_path / "m"))
    model.save(str(tmp_path / "m"))  # a second version
    again = boosted.predict_boosted(boosted.Boosted.load(spark, str(tmp_path / "m")), features)
    assert preds.exceptAll(again).isEmpty()


def test_new_category_gets_the_mean(spark, features):
    matrix, codes, names = boosted.model_matrix(features, val_days=20)
    other = features.filter(F.col("id") == DENSE).withColumns({"id": F.lit("new"), "item_id": F.lit("new")})
    coded = boosted.with_codes(other, codes)
    assert coded.select("item_id_code").distinct().collect()[0][0] == pytest.approx(codes.prior)
    assert coded.count() == DAYS and len(names) == 39


def test_dual(spark, master, features, tmp_path):
    ids = spark.createDataFrame([(SPARSE,)], "id string")
    model = dual.fit_dual(features, ids, val_days=20, rounds=60, leaves=8)
    preds = dual.predict_dual(model, features, ids).persist()
    assert preds.columns == ["id", "date", "dual_occurrence_prob", "dual_magnitude", "dual_point"]
    assert preds.count() == DAYS - 56
    assert preds.filter("dual_occurrence_prob < 0 or dual_occurrence_prob > 1 or dual_magnitude < 0 or dual_point > dual_magnitude + 0.001").isEmpty()
    assert dual.dual_forecast(model, features, ids, 7).count() == 7
    assert 0.0 <= dual.occurrence_auc(preds, master).first()["auc"] <= 1.0
    model.save(str(tmp_path / "d"))
    assert preds.exceptAll(dual.predict_dual(dual.Dual.load(spark, str(tmp_path / "d")), features, ids)).isEmpty()


def test_dual_with_one_outcome(spark, features):
    ids = spark.createDataFrame([(DENSE,)], "id string")
    preds = dual.predict_dual(dual.fit_dual(features, ids, val_days=20, rounds=3, leaves=4), features, ids)
    assert preds.filter("dual_occurrence_prob <> 1").isEmpty() and preds.filter("dual_point <= 0").isEmpty()


def test_dual_without_series(spark, features):
    none = spark.createDataFrame([], "id string")
    assert dual.predict_dual(dual.fit_dual(features, none), features, none).isEmpty()


def test_sequence(spark, master, features, tmp_path):
    # 18 windows a series at the weekly stride are too few to learn from; take every day.
    model = sequence.fit_sequence(features, val_days=20, stride=1)
    preds = sequence.predict_sequence(model, features).persist()
    assert preds.count() == 2 * (DAYS - 56 - 28) and preds.filter("lstm_point < 0").isEmpty()
    assert error(master, preds, "lstm_point", DENSE) < naive_error(master, DENSE)
    model.save(str(tmp_path / "s"))
    again = sequence.predict_sequence(sequence.Sequence.load(spark, str(tmp_path / "s")), features)
    assert preds.join(again.withColumnRenamed("lstm_point", "p"), ["id", "date"]).filter("abs(lstm_point - p) > 1e-9").isEmpty()


def test_sequence_is_fitted_on_every_window(spark, features, monkeypatch):
    """A series has a window for each row after its first 28 with all lags, as far as the training days go."""
    staged, own = [], sequence.stage

    def noted(df, name):
        staged.append(own(df, name))
        return staged[-1]

    monkeypatch.setattr(sequence, "stage", noted)
    sequence.fit_sequence(features, val_days=20, iterations=2)
    assert staged[-1].count() == 2 * (DAYS - 56 - 20 - 28)


def test_arima_beats_naive_and_skips_short(spark, master):
    short = master.filter((F.col("id") == SPARSE) & (F.col("date") < FIRST + dt.timedelta(days=50))).withColumn("id", F.lit("short"))
    preds = seasonal_arima.seasonal_arima(master.unionByName(short))
    assert {r["id"] for r in preds.select("id").distinct().collect()} == {DENSE, SPARSE}
    assert error(master, preds, "sarima_point", DENSE) < min(naive_error(master, DENSE), naive_error(master, DENSE, 7))


def test_arima_flat_series_gives_no_rows(series):
    assert seasonal_arima.seasonal_arima(series({"flat": [3] * 120})).isEmpty()


def test_arima_forecast(master):
    rows = seasonal_arima.seasonal_arima_forecast(master, horizon=14).orderBy("id", "date").collect()
    assert len(rows) == 28 and rows[0]["date"] == FIRST + dt.timedelta(days=DAYS)
    assert all(0 <= r["sarima_lower"] <= r["sarima_point"] <= r["sarima_upper"] for r in rows)
    dense = [r for r in rows if r["id"] == DENSE]
    high = [r["sarima_point"] for r in dense if r["date"].weekday() in (1, 2)]  # crest and trough of the weekly wave
    low = [r["sarima_point"] for r in dense if r["date"].weekday() in (5, 6)]
    assert sum(high) / len(high) > sum(low) / len(low) + 6


def test_ar_fit_matches_least_squares(series):
    r = random.Random(4)
    sales = [r.randint(0, 50) for _ in range(150)]
    got = seasonal_arima.seasonal_arima(series({"a": sales}), order=(1, 1, 0), seasonal=(1, 0, 0, 7)).orderBy("date").collect()
    y = np.array(sales, float)
    d = np.concatenate([[np.nan], np.diff(y)])
    t = np.arange(9, 150)
    x = np.column_stack([d[t - 1], d[t - 7], d[t - 8]])
    beta = np.linalg.lstsq(x, d[t], rcond=None)[0]
    want = np.maximum(y[t - 1] + x @ beta, 0)
    assert [row["sarima_point"] for row in got[9:]] == pytest.approx(want.tolist())


def test_difference_weights():
    assert seasonal_arima.difference_weights(1, 1, 7) == {1: -1.0, 7: -1.0, 8: 1.0}
    assert seasonal_arima.difference_weights(2, 0, 7) == {1: -2.0, 2: 1.0} and seasonal_arima.difference_weights(0, 0, 7) == {}


def test_slopes_are_those_of_the_shocks():
    rnd = np.random.default_rng(2)
    step, seen = rnd.normal(size=(40, 3)), rnd.random((40, 3)) > 0.1
    ar, ma = [1, 7], [1, 3]
    beta = rnd.uniform(-0.4, 0.4, (3, 4))
    out = seasonal_arima.shocks(step, seen, ar, ma, beta, slopes=True)
    for day in range(40):  # the recursion, written out
        want = step[day] - sum(beta[:, i] * step[day - k] for i, k in enumerate(ar) if day >= k)
        want = want - sum(beta[:, 2 + j] * out[day - k, :, 0] for j, k in enumerate(ma) if day >= k)
        assert out[day, :, 0] == pytest.approx(np.where(seen[day], want, 0))
    for w in range(4):
        near = beta.copy()
        near[:, w] += 1e-6
        rise = (seasonal_arima.shocks(step, seen, ar, ma, near)[:, :, 0] - out[:, :, 0]) / 1e-6
        assert rise == pytest.approx(out[:, :, 1 + w], abs=1e-4)


def test_refined_weights_lower_the_squares_and_find_the_true_ones():
    rnd = np.random.default_rng(5)
    noise = rnd.normal(size=(1500, 4))
    step = np.zeros_like(noise)
    for day in range(1500):
        step[day] = noise[day] + (0.6 * step[day - 1] + 0.5 * noise[day - 1] if day else 0) + (0.3 * noise[day - 7] if day >= 7 else 0)
    seen = np.ones(step.shape, bool)
    for start in (np.zeros((4, 3)), np.tile([0.2, 3.0, -2.0], (4, 1))):  # the second cannot be inverted
        beta, square = seasonal_arima.refine(step, seen, [1], [1, 7], start)
        with np.errstate(all="ignore"):
            before = (seasonal_arima.shocks(step, seen, [1], [1, 7], start) ** 2).sum(axis=(0, 2))
        assert not (square > before).any() and beta == pytest.approx(np.tile([0.6, 0.5, 0.3], (4, 1)), abs=0.12)


def test_seasonal_difference(series):
    r = random.Random(6)
    wave = [40, 10, 0, 25, 60, 80, 5]
    level, sales = 300.0, []
    for day in range(420):
        level += r.gauss(0.3, 2)
        sales.append(int(level) + wave[day % 7] + r.randint(-3, 3))
    panel = series({"a": sales})
    rows = seasonal_arima.seasonal_arima(panel, order=(1, 1, 1), seasonal=(1, 1, 1, 7)).orderBy("date").collect()
    got, y = np.array([x["sarima_point"] for x in rows]), np.array(sales, float)
    assert len(got) == 420 and np.abs(got - y)[60:].mean() < 0.8 * np.abs(y[7:] - y[:-7])[53:].mean()
    ahead = seasonal_arima.seasonal_arima_forecast(panel, horizon=14, order=(0, 1, 1), seasonal=(0, 1, 1, 7)).orderBy("date").collect()
    point = np.array([x["sarima_point"] for x in ahead])
    assert np.abs(point - (y[-7:].mean() - np.mean(wave) + np.array([wave[(420 + h) % 7] for h in range(14)]))).mean() < 10
    assert (np.diff([x["sarima_upper"] - x["sarima_lower"] for x in ahead]) > 0).all()
    # Without weights the forecast is the difference rule alone.
    rule = seasonal_arima.seasonal_arima_forecast(panel, horizon=9, order=(0, 1, 0), seasonal=(0, 1, 0, 7)).orderBy("date").collect()
    longer = list(y)
    for _ in range(9):
        longer.append(longer[-1] + longer[-7] - longer[-8])
    assert [x["sarima_point"] for x in rule] == pytest.approx(longer[420:])


def test_product_lags():
    assert seasonal_arima.product_lags(1, 1, 7) == [1, 7, 8]
    assert seasonal_arima.product_lags(2, 1, 7) == [1, 2, 7, 8, 9]
    assert seasonal_arima.product_lags(0, 0, 7) == []


def test_order_search_prefers_the_true_order(series):
    r = random.Random(9)
    level, steps, sales = 500.0, [0.0], []
    for _ in range(600):
        steps.append(0.8 * steps[-1] + r.gauss(0, 5))
        level += steps[-1]
        sales.append(int(level * 100))
    table = {(x["p"], x["q"]): x for x in seasonal_arima.order_search(series({"a": sales})).collect()}
    assert len(table) == 9 and sum(x["best"] for x in table.values()) == 1
    assert table[1, 0]["mean_aic"] < table[0, 0]["mean_aic"]


def _simulated(kind, seed, days=1500):
    r, level, rise, out = random.Random(seed), 0.0, 0.0, []
    for day in range(days):
        noise = r.gauss(0, 100)
        rise = rise + noise if kind == "twice" else noise
        level += rise
        out.append(int({"noise": noise, "walk": level, "twice": level, "weekly": 900 * (day % 7 == 2) + noise}[kind]))
    return out


def _level(values, bandwidth=14):
    """The level test straight from its definition, a sum for each lag."""
    e = np.asarray(values, float) - np.mean(values)
    spread = e @ e + sum(2 * (1 - k / (bandwidth + 1)) * (e[k:] @ e[:-k]) for k in range(1, bandwidth + 1))
    return (e.cumsum() ** 2).sum() / (len(e) * spread) if spread > 0 else 0.0


def test_difference_orders_of_four_kinds(series):
    data = {f"{kind}{i}": _simulated(kind, i) for kind in ("noise", "walk", "twice", "weekly") for i in range(6)}
    data |= {"flat": [4] * 100, "short": [1, 2, 3], "gaps": [None if i % 9 == 0 else v for i, v in enumerate(_simulated("noise", 9))]}
    found = {r["id"]: r for r in seasonal_arima.difference_orders(series(data)).collect()}
    assert found.keys() == data.keys() - {"short"}
    for name, row in found.items():
        values = np.array([v for v in data[name] if v is not None], float)
        left = values[7:] - values[:-7] if row["seasonal"] else values
        assert row["n"] == len(values)
        assert row["level_0"] == pytest.approx(_level(left), rel=1e-9)
        assert row["level_1"] == pytest.approx(_level(np.diff(left)), rel=1e-9)
        assert row["plain"] == (0 if row["level_0"] <= 0.463 else 1 if row["level_1"] <= 0.463 else 2)
    assert (found["flat"]["plain"], found["flat"]["seasonal"], found["flat"]["strength"]) == (0, 0, 0.0)
    wanted = {"noise": (0, 0), "walk": (1, 0), "twice": (2, 0), "weekly": (0, 1)}
    for kind, (plain, seasonal) in wanted.items():
        rows = [r for name, r in found.items() if name.startswith(kind)]
        assert all(r["seasonal"] == seasonal for r in rows), kind
        assert sum(r["plain"] == plain for r in rows) >= 5, kind  # a test at 5 % may miss one of six


def test_searched_arima_gives_each_series_its_differences(series):
    data = {"w": [v + 2000 for v in _simulated("weekly", 3, 200)], "n": [v + 2000 for v in _simulated("noise", 4, 200)], "s": [5] * 10}
    panel = series(data)
    tested = seasonal_arima.difference_orders(panel)
    orders = seasonal_arima.orders_by_class(panel, tested)
    assert [(o[1], s[1]) for o, s in orders] == [(0, 0), (0, 1)]
    rows = seasonal_arima.searched_arima(panel)
    assert rows.columns == ["id", "date", "sarima_point"]
    assert {r["id"]: r["count"] for r in rows.groupBy("id").count().collect()} == {"w": 200, "n": 200}
    assert seasonal_arima.searched_arima(panel.limit(0)).isEmpty()


def test_difference_orders_take_one_exchange(series):
    plan = seasonal_arima.difference_orders(series({"a": _simulated("walk", 1, 80)}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_decompose(master):
    days = decompose.holiday_days(master)
    preds = decompose.decompose(master, days)
    assert preds.columns == ["id", "date", "prophet_point", "prophet_lower", "prophet_upper", "trend"]
    assert preds.count() == 2 * DAYS and preds.filter("prophet_lower > prophet_upper or prophet_point < 0").isEmpty()
    assert error(master, preds, "prophet_point", DENSE) < naive_error(master, DENSE)
    ahead = decompose.decompose(master, days, horizon=7)
    assert ahead.count() == 14 and ahead.agg(F.min("date")).first()[0] == FIRST + dt.timedelta(days=DAYS)


def test_decompose_and_its_forecast_cost_one_exchange_on_id(series):
    frame = series({"a": [1] * 70})
    for horizon in (0, 7):
        plan = decompose.decompose(frame, decompose.holiday_days(frame), horizon)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(id") == 1


def test_decompose_skips_short(series):
    frame = series({"a": [1] * 59, "b": [1] * 60})
    ids = decompose.decompose(frame, decompose.holiday_days(frame)).select("id").distinct().collect()
    assert [r["id"] for r in ids] == ["b"]


def test_holiday_dates(spark):
    dates = spark.createDataFrame([(dt.date(2011, 6, 1),)], "date date")
    days = {r["holiday"]: r["day"] for r in decompose.holiday_days(dates).filter(F.year("day") == 2011).collect()}
    # The holidays of 2011.
    assert days == {
        "NewYear": dt.date(2011, 1, 1), "MLK": dt.date(2011, 1, 17), "PresidentsDay": dt.date(2011, 2, 21),
        "Easter": dt.date(2011, 4, 24), "MemorialDay": dt.date(2011, 5, 30), "IndependenceDay": dt.date(2011, 7, 4),
        "LaborDay": dt.date(2011, 9, 5), "Thanksgiving": dt.date(2011, 11, 24), "Christmas": dt.date(2011, 12, 25),
        "SuperBowl": dt.date(2011, 2, 6), "ValentinesDay": dt.date(2011, 2, 14), "Halloween": dt.date(2011, 10, 31)}
    christmas = decompose.expand_holidays(decompose.holiday_days(dates)).filter("holiday = 'Christmas' and year(date) = 2011")
    assert sorted(r["offset"] for r in christmas.collect()) == [-3, -2, -1, 0, 1, 2]


def test_easter(spark):
    years = spark.createDataFrame([(2000,), (2016,), (2024,), (2025,)], "y int").select(easter(F.col("y")).alias("e"))
    assert [r["e"] for r in years.collect()] == [dt.date(2000, 4, 23), dt.date(2016, 3, 27), dt.date(2024, 3, 31), dt.date(2025, 4, 20)]


def test_jobs_end_to_end(spark, master, features, tmp_path):
    from shelfcast.operators.classify import classify_demand
    store = TableStore(spark, str(tmp_path / "store"))
    store.replace("master", master)
    store.replace("features", features)
    store.replace("demand_classes", classify_demand(master))
    coverage = jobs.run_models(store)
    assert {r["model"]: r["state"] for r in coverage.collect()} == {m: "complete" for m in ("lgbm", "prophet", "sarima", "lstm", "dual_phase")}
    assert {r["model"] for r in jobs.run_models(store, models=[], skip_existing=True).collect()} >= {"lgbm"}
    scores = jobs.run_blend(store)
    assert {r["col"] for r in scores.collect()} == {"lgbm_point", "prophet_point", "sarima_point", "lstm_point", "dual_point", "ensemble_point"}
    assert jobs.run_blend(store, evaluate_only=True).count() == 6
    report = spark.read.option("header", True).csv(str(tmp_path / "store" / "reports" / "per_class_metrics"))
    assert report.columns == ["demand_class", "model", "RMSE", "MAE", "n"]
    assert not math.isnan(scores.filter("col = 'ensemble_point'").first()["WRMSSE"])

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features, sequence
from shelfcast.operators.baselines import naive_forecast
from shelfcast.operators.reshape import time_split


def by_day(df, column):
    return [r[column] for r in df.orderBy("date").collect()]


def test_rolling_starts(series):
    sales = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]
    rows = features.add_rolling(series({"a": sales})).orderBy("date").collect()
    assert [r["rolling_mean_7"] for r in rows[:7]] == [None] * 7
    assert [r["rolling_std_7"] for r in rows[:8]] == [0.0] * 8
    assert rows[8]["rolling_mean_7"] == 2.0
    assert rows[9]["rolling_std_7"] == pytest.approx(statistics.stdev([3, 1, 4]))
    assert (rows[9]["rolling_min_7"], rows[9]["rolling_max_7"]) == (1, 4)


def test_lags_count_rows(series):
    rows = features.add_lags(series({"a": list(range(60)), "b": list(range(100, 160))})).filter("id = 'b'")
    assert by_day(rows, "sales_lag_7")[:8] == [None] * 7 + [100]
    assert by_day(rows, "sales_lag_28")[28] == 100 and by_day(rows, "sales_lag_56")[57] == 101


def test_price_path(series):
    prices = [0, 0, 2, 2, 1.8, 1.8, 0]
    rows = features.add_price(series({"a": [1] * 7}, {"a": prices})).orderBy("date").collect()
    assert [r["price_change_pct"] for r in rows] == [0, 0, 0, 0, -0.1, 0, -1.0]
    assert [r["days_since_price_change"] for r in rows] == [0, 1, 0, 1, 0, 1, 0]
    means = [sum(prices[: i + 1]) / (i + 1) for i in range(7)]
    assert [r["is_promotion"] for r in rows] == [int(p > 0 and p < 0.95 * m) for p, m in zip(prices, means)]


def test_runs_without_sale(series):
    rows = features.add_demand(series({"a": [0, 0, 3, 0, 0, 0, 2, 1]}))
    assert by_day(rows, "days_since_last_sale") == [0, 1, 2, 0, 1, 2, 3, 0]
    rates = by_day(rows, "rolling_nonzero_rate_28")
    assert rates[0] == 0.0 and rates[3] == 0.25 and rates[7] == pytest.approx(2 / 8)


def test_calendar_and_events(spark):
    rows = [(dt.date(2016, 1, 3), "CA", "", "", 1, 0, 0), (dt.date(2016, 2, 29), "TX", "X", "Sporting", 1, 0, 1),
            (dt.date(2016, 12, 1), "NY", "Y", "Religious", 1, 1, 1)]
    df = spark.createDataFrame(rows, "date date, state_id string, event_name_1 string, event_type_1 string,"
                                     "snap_CA int, snap_TX int, snap_WI int")
    a, b, c = features.add_events(features.add_calendar(df)).orderBy("date").collect()
    assert (a["day_of_week"], a["week_of_year"], a["is_weekend"], a["snap_active"], a["has_event"]) == (6, 53, 1, 1, 0)
    assert (b["is_month_end"], b["quarter"], b["is_sporting"], b["snap_active"]) == (1, 1, 1, 0)
    assert (c["is_month_start"], c["is_religious"], c["snap_active"], c["month_cos"]) == (1, 1, 0, 1.0)


def test_feature_table_costs_one_exchange(series):
    df = series({"a": [1] * 30}).withColumns({
        **{c: F.lit("") for c in ("event_name_1", "event_type_1")}, **{c: F.lit(0) for c in ("snap_CA", "snap_TX", "snap_WI")}})
    plan = features.build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1
    assert plan.count("Sort [id") == 1


def test_time_split_is_global(series):
    flagged = time_split(series({"a": [1] * 40, "b": [1] * 10}), 28)
    assert flagged.filter("is_val").count() == 28
    assert flagged.filter("is_val and id = 'b'").count() == 0


def test_naive(series):
    rows = naive_forecast(series({"a": [1, 2, 3, 4, 5, 6, 7, 8]}))
    assert by_day(rows, "naive_point") == [None, 1, 2, 3, 4, 5, 6, 7]
    assert by_day(rows, "seasonal_point")[-1] == 1


def test_windows_stay_in_their_series(series):
    df = series({"a": list(range(40)), "b": list(range(100, 140)), "short": [1] * 20})
    rows = sequence.sequence_windows(df, ["sales", "sell_price"], length=28, stride=7).collect()
    assert {(r["id"], r["target"]) for r in rows} == {("a", 28.0), ("a", 35.0), ("b", 128.0), ("b", 135.0)}
    first = next(r for r in rows if r["target"] == 128.0)
    assert len(first["window"]) == 56 and first["window"][:2] == [100.0, 1.0] and first["window"][-2] == 127.0


def test_scaling_uses_population_deviation(series):
    stats = sequence.scaling_stats(series({"a": [1, 2, 3, 4]}), ["sales"]).first()
    assert stats["mean"] == 2.5 and stats["std"] == pytest.approx(statistics.pstdev([1, 2, 3, 4]))

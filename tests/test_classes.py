import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import classify
from shelfcast.operators.reshape import history_window, sample_series

def spaced(gap: int, sizes: list[int], times: int) -> list[int]:
    """Each size after ``gap`` - 1 empty days, the list of sizes repeated: ADI is the gap."""
    return [x for _ in range(times) for size in sizes for x in [0] * (gap - 1) + [size]]


# Two sizes m - d and m + d in turn, n sales: the sample variance is n / (n - 1) x d^2, so CV^2 is that over m^2.
CASES = {
    "smooth": (spaced(1, [18, 22], 52), "Smooth", 1.0, 104 / 103 * 0.01),
    "erratic": (spaced(1, [3, 37], 45), "Erratic", 1.0, 90 / 89 * 0.85 ** 2),
    "intermittent": (spaced(4, [7, 9], 13), "Intermittent", 4.0, 26 / 25 / 64),
    "lumpy": (spaced(3, [1, 23], 17), "Lumpy", 3.0, 34 / 33 * (11 / 12) ** 2),
    "zero": ([0] * 77, "Intermittent", math.inf, 0.0),
    "single": (spaced(9, [4], 1), "Intermittent", 9.0, 0.0),
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, k, "d", "c", "s", "CA", dt.date(2019, 6, 30) - dt.timedelta(days=len(v) - i), x)
            for k, (v, *_) in CASES.items() for i, x in enumerate(v)]
    master = spark.createDataFrame(data, "id string, item_id string, dept_id string, cat_id string, store_id string,"
                                         "state_id string, date date, sales bigint")
    return {r["id"]: r for r in classify.classify_demand(master).collect()}


@pytest.mark.parametrize("name", CASES)
def test_class(rows, name):
    _, demand_class, adi, cv2 = CASES[name]
    assert (rows[name]["demand_class"], rows[name]["adi"], rows[name]["cv2"]) == (demand_class, round(adi, 4), round(cv2, 4))


def test_all_zero(rows):
    r = rows["zero"]
    assert math.isinf(r["adi"]) and r["cv2"] == 0.0 and r["zero_rate"] == 1.0
    assert r["mean_nonzero_sales"] == 0.0 and r["nonzero_periods"] == 0


def test_one_sale_has_no_variation(rows):
    assert rows["single"]["cv2"] == 0.0 and rows["single"]["adi"] == 9.0


def test_a_limit_counts_as_above(series):
    """33 days with 25 sales have an ADI of exactly 1.32."""
    at = {"at": [5] * 24 + [0] * 8 + [5], "under": [5] * 25 + [0] * 7 + [5]}
    rows = {r["id"]: r for r in classify.classify_demand(series(at)).collect()}
    assert rows["at"]["demand_class"] == "Intermittent" and rows["under"]["demand_class"] == "Smooth"


def test_history_is_inclusive(series):
    frame = series({"a": list(range(500))})
    assert history_window(frame, 365).count() == 366


def test_routing_and_cap(spark):
    classes = spark.createDataFrame(
        [("b", "Smooth"), ("a", "Smooth"), ("c", "Erratic"), ("d", "Lumpy"), ("e", "Intermittent")], "id string, demand_class string")
    routing = classify.model_routing(classes)
    by_model = {}
    for r in routing.collect():
        by_model.setdefault(r["model"], set()).add(r["id"])
    assert by_model == {"sarima": {"a", "b"}, "prophet": {"a", "b", "c"}, "lgbm": {"a", "b", "c", "d", "e"},
                        "lstm": {"a", "b", "c"}, "dual_phase": {"d", "e"}}
    capped = classify.cap_routing(routing, 1).collect()
    assert {(r["model"], r["id"]) for r in capped} == {
        ("sarima", "a"), ("prophet", "a"), ("lgbm", "a"), ("lstm", "a"), ("dual_phase", "e")}


def test_sample_is_stable(spark):
    ids = spark.range(100).select(F.col("id").cast("string").alias("id"))
    first = {r["id"] for r in sample_series(ids.unionByName(ids), 10).collect()}
    again = {r["id"] for r in sample_series(ids.repartition(7), 10).collect()}
    assert first == again and len(first) == 10
    assert first != {r["id"] for r in sample_series(ids, 10, seed=7).collect()}

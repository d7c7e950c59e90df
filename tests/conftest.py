from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfcast.session import session  # noqa: E402

IDS = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string"
START = dt.date(2016, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    spark = session("local[8]", 4, **{"spark.checkpoint.dir": folder, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                      "spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture
def series(spark):
    """A master-like frame from {id: [sales, ...]}, one row per day, with optional prices."""
    def build(sales: dict[str, list], prices: dict[str, list] | None = None, start: dt.date = START):
        rows = []
        for name, values in sales.items():
            for i, v in enumerate(values):
                price = float(prices[name][i]) if prices else 1.0
                rows.append((name, f"item_{name}", "d", "c", "s", "CA", start + dt.timedelta(days=i), v, price))
        return spark.createDataFrame(rows, IDS + ", date date, sales bigint, sell_price double")
    return build

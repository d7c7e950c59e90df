"""Time-series features of the panel.

All window features share one specification, so the whole table costs one exchange and
one sort on ``id``; expressions sit in two layers (lags, then runs over lags).  A series
has one row per day, which bounds every window partition by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.calendar import cyclic, flag
from shelfcast.operators.reshape import keep_ids

# Names and windows of the feature table.
LAGS = [7, 14, 28, 56]
WINDOWS = [7, 28]
EVENT_KINDS = {"is_sporting": "Sporting", "is_cultural": "Cultural",
               "is_national": "National", "is_religious": "Religious"}
CATEGORY_COLS = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
MODEL_COLS = [
    "item_id", "dept_id", "cat_id", "store_id", "state_id",
    "day_of_week", "week_of_year", "month", "year", "quarter",
    "is_weekend", "is_month_start", "is_month_end",
    "dow_sin", "dow_cos", "month_sin", "month_cos",
    "is_sporting", "is_cultural", "is_national", "is_religious",
    "has_event", "snap_active",
    "sell_price", "price_change_pct", "is_promotion", "days_since_price_change",
    "sales_lag_7", "sales_lag_14", "sales_lag_28", "sales_lag_56",
    "rolling_mean_7", "rolling_mean_28", "rolling_std_7", "rolling_std_28",
    "rolling_min_7", "rolling_max_7",
    "days_since_last_sale", "rolling_nonzero_rate_28",
]



def by_series() -> WindowSpec:
    return Window.partitionBy("id").orderBy("date")


def so_far() -> WindowSpec:
    return by_series().rowsBetween(Window.unboundedPreceding, 0)


def add_calendar(df: DataFrame) -> DataFrame:
    date, dow = F.col("date"), F.weekday("date")
    dow_sin, dow_cos = cyclic(dow, 7)
    month_sin, month_cos = cyclic(F.month(date), 12)
    return df.withColumns({
        "day_of_week": dow, "week_of_year": F.weekofyear(date), "month": F.month(date),
        "year": F.year(date), "quarter": F.quarter(date),
        "is_weekend": flag(dow >= 5), "is_month_start": flag(F.dayofmonth(date) == 1),
        "is_month_end": flag(F.last_day(date) == date),
        "dow_sin": dow_sin, "dow_cos": dow_cos, "month_sin": month_sin, "month_cos": month_cos,
    })


def add_events(df: DataFrame) -> DataFrame:
    """Kind of the first event, and the food-aid flag of the row's own state."""
    kinds = {name: flag(F.col("event_type_1") == kind) for name, kind in EVENT_KINDS.items()}
    own_state = (F.when(F.col("state_id") == "CA", F.col("snap_CA"))
                 .when(F.col("state_id") == "TX", F.col("snap_TX"))
                 .when(F.col("state_id") == "WI", F.col("snap_WI")).otherwise(0))
    return df.withColumns({
        **kinds, "has_event": flag(F.col("event_name_1") != ""),
        "snap_active": F.least(F.greatest(own_state, F.lit(0)), F.lit(1)),
    })


def add_price(df: DataFrame) -> DataFrame:
    """Price against its 30-row mean and against yesterday; rows since it last moved."""
    price, before = F.col("sell_price"), F.col("_price_before")
    moved = F.when(before.isNull() | (price != before), F.col("_row"))
    mean_30 = F.avg("sell_price").over(by_series().rowsBetween(-29, 0))
    return (
        df.withColumns({"_price_before": F.lag("sell_price").over(by_series()),
                        "_row": F.row_number().over(by_series()), "price_roll30": mean_30})
        .withColumns({
            "price_change_pct": F.round(F.coalesce((price - before) / F.nullif(before, F.lit(0.0)), F.lit(0.0)), 6),
            "is_promotion": flag((price > 0) & (price < F.col("price_roll30") * 0.95)),
            "days_since_price_change": F.col("_row") - F.max(moved).over(so_far()),
        })
        .drop("_price_before", "_row")
    )


def add_lags(df: DataFrame, lags: list[int] = LAGS) -> DataFrame:
    return df.withColumns({f"sales_lag_{k}": F.lag("sales", k).over(by_series()) for k in lags})


def add_rolling(df: DataFrame, windows: list[int] = WINDOWS, base_lag: int = 7) -> DataFrame:
    """Statistics of the ``w`` rows that end ``base_lag`` rows back."""
    def rows(w: int):
        return by_series().rowsBetween(-(w + base_lag - 1), -base_lag)

    cols = {}
    for w in windows:
        cols[f"rolling_mean_{w}"] = F.avg("sales").over(rows(w))
        cols[f"rolling_std_{w}"] = F.coalesce(F.stddev_samp("sales").over(rows(w)), F.lit(0.0))
    cols["rolling_min_7"] = F.min("sales").over(rows(7))
    cols["rolling_max_7"] = F.max("sales").over(rows(7))
    return df.withColumns(cols)


def add_demand(df: DataFrame) -> DataFrame:
    """Length of the run of days without sale up to yesterday, and share of days sold."""
    yesterday, row = F.col("_yesterday"), F.col("_row")
    run_breaks = F.when(yesterday.isNull() | (yesterday != 0), row)
    return (
        df.withColumns({"_yesterday": F.lag("sales").over(by_series()), "_row": F.row_number().over(by_series())})
        .withColumns({
            "days_since_last_sale": row - F.max(run_breaks).over(so_far()),
            "rolling_nonzero_rate_28":
                F.avg(flag(yesterday > 0).cast("double")).over(by_series().rowsBetween(-27, 0)),
        })
        .drop("_yesterday", "_row")
    )


def build_features(master: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The feature table of the panel, or of the series named in ``ids``."""
    df = master if ids is None else keep_ids(master, ids)
    for step in (add_calendar, add_events, add_price, add_lags, add_rolling, add_demand):
        df = step(df)
    return df

"""Reshape, join and filter operators on the panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ID_COLS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
EVENT_COLS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
SNAP_COLS = ["snap_CA", "snap_TX", "snap_WI"]


def melt_sales(wide: DataFrame, id_cols: list[str] = ID_COLS, prefix: str = "d_") -> DataFrame:
    """Day columns to rows ``(ids, d, sales)``; an empty cell counts as 0.

    One generator over an array of the cells: with thousands of day columns this plans
    and runs faster than one projection per column, and needs no shuffle.  The array is
    one SQL expression, since a call per column would take longer than the job.
    """
    days = [c for c in wide.columns if c.startswith(prefix)]
    cells = F.expr("array(" + ", ".join(f"`{c}`" for c in days) + ")")
    names = F.expr("array(" + ", ".join(f"'{c}'" for c in days) + ")")
    return (
        wide.select(*id_cols, F.posexplode(cells).alias("pos", "cell"))
        .select(*id_cols, F.element_at(names, F.col("pos") + 1).alias("d"),
                F.coalesce(F.col("cell").cast("bigint"), F.lit(0).cast("bigint")).alias("sales"))
    )


def build_master(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """Sales with their day and week price: inner on ``d``, left on store, item and week.

    Days outside the calendar are lost; a missing price is 0.0, a missing event ''.
    No join is forced: the planner broadcasts a side when its known size allows.
    """
    days = calendar.select("d", F.col("date").cast("date").alias("date"), "wm_yr_wk", "weekday",
                           *EVENT_COLS, *SNAP_COLS)
    return (
        sales.join(days, "d")
        .join(prices.select("store_id", "item_id", "wm_yr_wk", "sell_price"),
              ["store_id", "item_id", "wm_yr_wk"], "left")
        .select(*ID_COLS, "date", "d", F.col("wm_yr_wk").cast("int").alias("wm_yr_wk"),
                F.col("sales").cast("bigint").alias("sales"),
                F.coalesce(F.col("sell_price").cast("double"), F.lit(0.0)).alias("sell_price"),
                "weekday", F.month("date").alias("month"), F.year("date").alias("year"),
                *[F.coalesce(c, F.lit("")).alias(c) for c in EVENT_COLS],
                *[F.col(c).cast("int").alias(c) for c in SNAP_COLS])
    )


def keep_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the series named in ``ids.id``."""
    return df.join(ids.select("id"), "id", "left_semi")


def sample_series(ids: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` series in an order fixed by a hash of the id and the seed."""
    key = F.md5(F.concat_ws(":", F.col("id"), F.lit(str(seed))))
    return ids.select("id").distinct().orderBy(key, "id").limit(n)


def history_window(df: DataFrame, days: int) -> DataFrame:
    """The last ``days`` days and the newest one: ``days + 1`` dates."""
    return df.filter(F.col("date") >= F.date_sub(df.agg(F.max("date")).scalar(), days))


def time_split(df: DataFrame, val_days: int = 28) -> DataFrame:
    """Flags the last ``val_days`` dates of the whole frame in ``is_val``."""
    return df.withColumn("is_val", F.col("date") > F.date_sub(df.agg(F.max("date")).scalar(), val_days))


def drop_null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def scan_features(features: DataFrame, cols: list[str], ids: DataFrame | None = None) -> DataFrame:
    """Model columns of the wanted series, without rows that lack the longest lag."""
    rows = features if ids is None else keep_ids(features, ids)
    wanted = list(dict.fromkeys(["id", "date", "sales", *[c for c in cols if c in features.columns]]))
    return rows.filter(F.col("sales_lag_56").isNotNull()).select(*wanted)


def single_series(master: DataFrame, series_id: str) -> DataFrame:
    return master.filter(F.col("id") == series_id).select("date", "sales").orderBy("date")


def matching(**wanted: str | None) -> Column:
    """A predicate from the filters that are set."""
    terms = [F.col(name) == value for name, value in wanted.items() if value]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def last_n_per_series(df: DataFrame, n: int = 28) -> DataFrame:
    newest = Window.partitionBy("id").orderBy(F.col("date").desc())
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def ordered_panel(df: DataFrame) -> DataFrame:
    """Series kept whole in a partition and sorted by date; no global sort."""
    return df.repartition("id").sortWithinPartitions("id", "date")


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

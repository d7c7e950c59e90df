"""Demand panels derived from the star-schema benchmark tables.

Two levels share one panel: each part type over all regions, and each brand in each
region.  ``lineitem`` is scanned once into a compact daily table which is staged; all
else starts from there.  A series has at most one row per calendar day, so windows
over ``id`` stay bounded by the calendar however large ``lineitem`` is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.staging import stage

IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _state(key: str):
    return F.element_at(F.array(F.lit("CA"), F.lit("TX"), F.lit("WI")), (F.col(key) % 3 + 1).cast("int"))


def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with sales per series: ids, ``date``, ``sales`` (units), ``cents``."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    regions = (
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_regionkey", "r_name")
    )
    # At most types x brands x regions x days rows come out of this aggregate.
    cells = (
        table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                F.col("l_shipdate").cast("date").alias("date"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(regions, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("p_type", "p_brand", "r_regionkey", "r_name", "date")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
             F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("paid"))
    )
    # Both levels from the compact cells; names are made once per result row.
    brand = F.col("p_brand").isNotNull()
    number = F.substring("p_brand", 7, 10).cast("int")
    brand_cat = F.concat(F.lit("CAT_"), (number % 2).cast("string"))
    return (
        cells.groupingSets([["p_type", "date"], ["p_brand", "r_regionkey", "r_name", "date"]],
                           "p_type", "p_brand", "r_regionkey", "r_name", "date")
        .agg(F.sum("units").alias("sales"), F.sum("paid").alias("cents"))
        .select(
            F.when(brand, F.concat("p_brand", F.lit("_"), "r_name")).otherwise(F.concat("p_type", F.lit("_ALL"))).alias("id"),
            F.when(brand, F.col("p_brand")).otherwise(F.col("p_type")).alias("item_id"),
            F.when(brand, F.concat(brand_cat, F.lit("_"), (number % 3).cast("string"))).otherwise("CAT_T_0").alias("dept_id"),
            F.when(brand, brand_cat).otherwise("CAT_T").alias("cat_id"),
            F.when(brand, F.col("r_name")).otherwise("ALL").alias("store_id"),
            F.when(brand, _state("r_regionkey")).otherwise("CA").alias("state_id"),
            "date", "sales", "cents")
    )


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second panel: events per user and day, in the same shape."""
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").cast("string").alias("user"), F.col("ts").cast("date").alias("date"))
        .groupBy("user", "date").agg(F.count(F.lit(1)).alias("sales"))
        .select(F.concat(F.lit("user_"), "user").alias("id"), F.lit("events").alias("item_id"),
                F.lit("events").alias("dept_id"), F.lit("events").alias("cat_id"),
                F.lit("ALL").alias("store_id"), F.lit("CA").alias("state_id"), "date", "sales")
    )


def fill_days(sparse: DataFrame) -> DataFrame:
    """One row per series and calendar day; days without a row get 0 sales.

    Each row emits itself and the empty days up to the next row of its series, so one
    exchange on ``id`` does it: no id-by-day product is joined.  The partition count is
    set, because sizes before the rows are filled in would mislead adaptive merging.
    """
    parts = int(sparse.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_id = Window.partitionBy("id").orderBy("date")
    first_day = sparse.agg(F.min("date")).scalar()
    last_day = sparse.agg(F.max("date")).scalar()
    return (
        sparse.select(*IDS, "date", "sales").repartition(parts, "id")
        .withColumn("opens", F.when(F.lag("date").over(by_id).isNull(), first_day).otherwise(F.col("date")))
        .withColumn("closes", F.coalesce(F.date_sub(F.lead("date").over(by_id), 1), last_day))
        .select(*IDS, F.col("date").alias("sold_on"), "sales",
                F.explode(F.sequence("opens", "closes")).alias("date"))
        .select(*IDS, "date", F.when(F.col("date") == F.col("sold_on"), F.col("sales"))
                .otherwise(F.lit(0).cast("bigint")).alias("sales"))
    )


def calendar(days: DataFrame) -> DataFrame:
    """One row per day from the first to the last of ``days.date``, with fixed-rule events."""
    first_day = days.agg(F.min("date")).scalar()
    n = F.col("n")
    month, day = F.month("date"), F.dayofmonth("date")
    monthday = month * 100 + day
    sunday = F.weekday("date") == 6
    # Month-day events of the generated calendar.
    name_1 = (F.when(monthday == 101, "NewYear").when(monthday == 107, "OrthodoxChristmas")
              .when(monthday == 214, "ValentinesDay").when((month == 2) & sunday & (day <= 7), "SuperBowl")
              .when(monthday == 704, "IndependenceDay").when(monthday == 1031, "Halloween")
              .when(monthday == 1225, "Christmas"))
    type_1 = (F.when(monthday.isin(101, 704, 1225), "National").when(monthday == 107, "Religious")
              .when(monthday.isin(214, 1031), "Cultural").when((month == 2) & sunday & (day <= 7), "Sporting"))
    name_2 = F.when((monthday == 214) & sunday, "LentStart")
    type_2 = F.when((monthday == 214) & sunday, "Religious")
    return (
        days.agg(F.min("date").alias("a"), F.max("date").alias("b"))
        .select(F.explode(F.sequence("a", "b")).alias("date"))
        .withColumn("n", F.datediff("date", first_day))
        .select("date", F.concat(F.lit("d_"), (n + 1).cast("string")).alias("d"),
                F.floor(n / 7).cast("int").alias("wm_yr_wk"),
                F.date_format("date", "EEEE").alias("weekday"), (F.weekday("date") + 1).alias("wday"),
                month.alias("month"), F.year("date").alias("year"),
                name_1.alias("event_name_1"), type_1.alias("event_type_1"),
                name_2.alias("event_name_2"), type_2.alias("event_type_2"),
                # One state is paid in odd weeks, one at month's end, one on the primes of a fortnight.
                ((F.floor(n / 7) % 2 == 1) & (F.weekday("date") < 5)).cast("int").alias("snap_CA"),
                (day > 21).cast("int").alias("snap_TX"),
                (n % 14).isin(2, 3, 5, 7, 11, 13).cast("int").alias("snap_WI"))
    )


@dataclass
class Raw:
    """The three inputs of the panel, in the shape of the raw files."""

    sales: DataFrame
    calendar: DataFrame
    prices: DataFrame


def raw_tables(spark: SparkSession, sf_dir: str) -> Raw:
    """Long daily sales, calendar and weekly prices of the derived panel."""
    demand = stage(daily_demand(spark, sf_dir), "daily_demand")
    first_day = demand.agg(F.min("date")).scalar()
    day_no = F.datediff("date", first_day)
    sales = fill_days(demand).select(*IDS, F.concat(F.lit("d_"), (day_no + 1).cast("string")).alias("d"), "sales")
    prices = (
        demand.groupBy("store_id", "item_id", F.floor(day_no / 7).cast("int").alias("wm_yr_wk"))
        .agg(F.sum("cents").alias("paid"), F.sum("sales").alias("units"))
        # Whole cents per unit, rounded half up in integers, so no engine can differ.
        .select("store_id", "item_id", "wm_yr_wk",
                (F.expr("(2 * paid + units) div nullif(2 * units, 0)") / 100.0).alias("sell_price"))
    )
    return Raw(sales, calendar(demand), prices)

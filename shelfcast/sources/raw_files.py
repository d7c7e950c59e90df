"""The raw CSV inputs: wide daily sales, calendar, weekly prices."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.reshape import ID_COLS

# Names of the raw files and types of their columns.
SALES, CALENDAR, PRICES = "sales_train_evaluation.csv", "calendar.csv", "sell_prices.csv"
PRICE_TYPES = {"wm_yr_wk": "int", "sell_price": "double"}
CALENDAR_TYPES = {"date": "date", "wm_yr_wk": "int", "wday": "int", "month": "int", "year": "int",
                  "snap_CA": "int", "snap_TX": "int", "snap_WI": "int"}


@dataclass
class RawFiles:
    wide_sales: DataFrame
    calendar: DataFrame
    prices: DataFrame


def check_inputs(spark: SparkSession, folder: str) -> None:
    """Fails with the names of all inputs that are absent."""
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    paths = {name: jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}") for name in (SALES, CALENDAR, PRICES)}
    absent = [name for name, path in paths.items() if not path.getFileSystem(conf).exists(path)]
    if absent:
        raise FileNotFoundError(f"absent from {folder}: {', '.join(absent)}")


def _reader(spark: SparkSession):
    """CSV with a header; more columns than any calendar has days."""
    return spark.read.option("header", True).option("maxColumns", 1_000_000)


def _read(spark: SparkSession, path: str, kind_of) -> DataFrame:
    """A file with the type ``kind_of(column)`` for each column of its header, in the header's order.

    The data is never scanned to infer types.  A cell that does not fit its type fails the read: it
    must not pass for an absent one.
    """
    names = _reader(spark).option("inferSchema", False).csv(path).columns  # from the first line only
    schema = ", ".join(f"`{c}` {kind_of(c)}" for c in names)
    return _reader(spark).schema(schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def read_raw(spark: SparkSession, folder: str) -> RawFiles:
    """The three inputs."""
    check_inputs(spark, folder)
    return RawFiles(_read(spark, f"{folder}/{SALES}", lambda c: "bigint" if c.startswith("d_") else "string"),
                    _read(spark, f"{folder}/{CALENDAR}", lambda c: CALENDAR_TYPES.get(c, "string")),
                    _read(spark, f"{folder}/{PRICES}", lambda c: PRICE_TYPES.get(c, "string")))


def widen(sales: DataFrame) -> DataFrame:
    """Long daily sales to one row per series with a column per day; a day without a row is NULL.

    Days are the columns of the result, so their names (one per calendar day) are listed first.
    Each series is folded into one array with a place per day, and only then become places columns:
    a task over thousands of columns costs seconds before its first row, so the narrow rows are
    exchanged in between, where adaptive merging leaves as many tasks as they need.  Of several
    rows for a day the largest counts.
    """
    days = [r["d"] for r in sales.select("d").distinct().filter(F.col("d").isNotNull())
            .orderBy(F.substring_index("d", "_", -1).cast("int")).collect()]
    places = sales.sparkSession.createDataFrame(pd.DataFrame({"place": range(len(days)), "d": days}), "place int, d string")
    kind, n = sales.schema["sales"].dataType.simpleString(), len(days)
    after = f"coalesce(get(sold, i + 1).place, {n})"
    folded = (
        sales.join(F.broadcast(places), "d", "left").groupBy(*ID_COLS)
        .agg(F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "sales")))).alias("sold"))
        # Each row brings its cell and the empty ones up to the next row.
        .select(*ID_COLS, F.expr(f"""
            flatten(concat(array(array_repeat(CAST(NULL AS {kind}), coalesce(get(sold, 0).place, {n}))),
                transform(sold, (s, i) -> CASE WHEN {after} = s.place THEN array()
                    ELSE concat(array(s.sales), array_repeat(CAST(NULL AS {kind}), {after} - s.place - 1)) END)))""").alias("cells"))
        .repartition(*ID_COLS)
    )
    return folded.selectExpr(*ID_COLS, *[f"cells[{i}] AS `{day}`" for i, day in enumerate(days)])


def write_raw(folder: str, sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> None:
    """Long sales, calendar and prices in the layout of the raw files."""
    for name, df in ((SALES, widen(sales)), (CALENDAR, calendar), (PRICES, prices)):
        df.write.option("header", True).csv(f"{folder}/{name}")

"""Trend times weekly, yearly, monthly and holiday factors, with an error band.

Each series stays in the partition of its ``id`` from the first window to the last:
windows over (id, weekday) and the like are met by the same exchange, so the whole fit
and forecast is one shuffle.  No window holds more rows than a series has days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import easter
from shelfcast.operators.features import by_series, so_far

# Days before and after each holiday that it moves.
HOLIDAY_SPANS = {
    "NewYear": (-1, 1), "MLK": (0, 0), "PresidentsDay": (0, 0), "Easter": (0, 0), "MemorialDay": (-1, 0),
    "IndependenceDay": (-1, 1), "LaborDay": (-1, 0), "Thanksgiving": (-2, 1), "Christmas": (-3, 2),
    "SuperBowl": (-1, 0), "ValentinesDay": (-1, 0), "Halloween": (-1, 0),
}
TREND_REACH = 182
PRIOR_ROWS = 5.0


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def _on_or_after(date: Column, weekday: str) -> Column:
    return F.next_day(F.date_sub(date, 1), weekday)


def holiday_days(dates: DataFrame) -> DataFrame:
    """(holiday, day, lower, upper) for every year that ``dates.date`` touches, and one on each side."""
    y = F.col("year")
    rules = {
        "NewYear": _day(y, 1, 1), "MLK": _on_or_after(_day(y, 1, 15), "Mon"),
        "PresidentsDay": _on_or_after(_day(y, 2, 15), "Mon"), "Easter": easter(y),
        "MemorialDay": _on_or_after(_day(y, 5, 25), "Mon"), "IndependenceDay": _day(y, 7, 4),
        "LaborDay": _on_or_after(_day(y, 9, 1), "Mon"), "Thanksgiving": _on_or_after(_day(y, 11, 22), "Thu"),
        "Christmas": _day(y, 12, 25), "SuperBowl": _on_or_after(_day(y, 2, 1), "Sun"),
        "ValentinesDay": _day(y, 2, 14), "Halloween": _day(y, 10, 31),
    }
    rows = F.array(*[
        F.struct(F.lit(name).alias("holiday"), rules[name].alias("day"),
                 F.lit(lo).alias("lower"), F.lit(hi).alias("upper"))
        for name, (lo, hi) in HOLIDAY_SPANS.items()])
    years = dates.agg((F.year(F.min("date")) - 1).alias("a"), (F.year(F.max("date")) + 1).alias("b"))
    return years.select(F.explode(F.sequence("a", "b")).alias("year")).select(F.explode(rows).alias("h")).select("h.*")


def expand_holidays(holidays: DataFrame) -> DataFrame:
    """One row per day a holiday moves, so that joining on the date needs no range condition."""
    span = F.sequence(F.date_add("day", F.col("lower")), F.date_add("day", F.col("upper")))
    return (holidays.select("holiday", "day", F.explode(span).alias("date"))
            .select("date", "holiday", F.datediff("date", "day").alias("offset")))


def _with_future(panel: DataFrame, horizon: int) -> DataFrame:
    """The panel plus ``horizon`` empty days after the last row of each series."""
    last = F.lead("date").over(by_series()).isNull()
    days = F.when(last, F.sequence("date", F.date_add("date", horizon))).otherwise(F.array("date"))
    return (
        panel.select("id", "date", F.col("sales").cast("double").alias("y"), days.alias("days"))
        .select("id", F.col("date").alias("seen"), "y", F.explode("days").alias("date"))
        .select("id", "date", F.when(F.col("date") == F.col("seen"), F.col("y")).alias("y"))
    )


def _factor(ratio: Column, *keys: str) -> Column:
    """Mean ratio of the rows that share the keys, drawn to 1 when they are few."""
    rows = Window.partitionBy("id", *keys)
    return (F.coalesce(F.sum(ratio).over(rows), F.lit(0.0)) + PRIOR_ROWS) / (F.count(ratio).over(rows) + PRIOR_ROWS)


def decompose(panel: DataFrame, holidays: DataFrame, horizon: int = 0, min_rows: int = 60,
              band: tuple[float, float] = (0.1, 0.9)) -> DataFrame:
    """Rows (id, date, prophet_point, prophet_lower, prophet_upper, trend).

    With ``horizon`` 0 the fitted days, else the next ``horizon`` days of each series.
    The trend is a centred mean of a year (running sums, so its cost does not depend on
    the span), carried on by a line through the last half year.
    """
    keys = (expand_holidays(holidays).groupBy("date")
            .agg(F.array_join(F.array_sort(F.collect_set(
                F.concat_ws(":", "holiday", F.col("offset").cast("string")))), "+").alias("holiday_key")))
    rows = panel.select("id", "date", "sales") if horizon == 0 else panel
    rows = (rows.select("id", "date", F.col("sales").cast("double").alias("y")) if horizon == 0
            else _with_future(rows, horizon))
    whole = Window.partitionBy("id")
    rn, n, recent = F.col("rn"), F.col("n"), F.col("rn") > F.col("n") - TREND_REACH
    seen = F.least(rn + TREND_REACH, n) - F.greatest(rn - TREND_REACH - 1, F.lit(0))
    middle = (F.coalesce("ahead", "total") - F.coalesce("behind", F.lit(0.0))) / seen
    line = F.greatest(F.col("intercept") + F.col("slope") * rn, F.lit(0.0))
    point = F.col("trend") * F.col("weekly") * F.col("yearly") * F.col("monthly") * F.col("special")
    fitted = (
        # At most holidays x span x years rows, so every executor can hold them.
        rows.join(F.broadcast(keys), "date", "left")
        .withColumns({
            "rn": F.row_number().over(by_series()), "cum": F.coalesce(F.sum("y").over(so_far()), F.lit(0.0)),
            "n": F.count("y").over(whole), "total": F.sum("y").over(whole)})
        .filter(n >= min_rows)
        .withColumns({
            "ahead": F.lead("cum", TREND_REACH).over(by_series()),
            "behind": F.lag("cum", TREND_REACH + 1).over(by_series()),
            "slope": F.regr_slope(F.when(recent, F.col("y")), rn.cast("double")).over(whole),
            "intercept": F.regr_intercept(F.when(recent, F.col("y")), rn.cast("double")).over(whole),
            "weekday": F.weekday("date"), "month": F.month("date"),
            # Half days keep the 30.5-day cycle in whole numbers.
            "cycle": F.floor((F.datediff("date", F.lit("1970-01-01").cast("date")) * 2 % 61) / 2)})
        .withColumn("trend", F.when(rn <= n, middle).otherwise(line))
        .withColumn("ratio", F.col("y") / F.nullif("trend", F.lit(0.0)))
        .withColumn("weekly", _factor(F.col("ratio"), "weekday"))
        .withColumn("yearly", _factor(F.col("ratio") / F.col("weekly"), "month"))
        .withColumn("monthly", _factor(F.col("ratio") / F.col("weekly") / F.col("yearly"), "cycle"))
        .withColumn("special", F.when(F.col("holiday_key").isNull(), F.lit(1.0)).otherwise(
            _factor(F.col("ratio") / F.col("weekly") / F.col("yearly") / F.col("monthly"), "holiday_key")))
        .withColumn("point", point)
        .withColumn("spread", F.percentile(F.col("y") / F.nullif("point", F.lit(0.0)), F.array(*map(F.lit, band))).over(whole))
    )
    kept = fitted if horizon == 0 else fitted.filter(rn > n)
    return kept.select("id", "date", F.greatest("point", F.lit(0.0)).alias("prophet_point"),
                       F.greatest(F.col("point") * F.col("spread")[0], F.lit(0.0)).alias("prophet_lower"),
                       F.greatest(F.col("point") * F.col("spread")[1], F.lit(0.0)).alias("prophet_upper"), "trend")


def future_dates(panel: DataFrame, horizon: int = 28) -> DataFrame:
    """The next ``horizon`` days of each series."""
    return (panel.groupBy("id").agg(F.max("date").alias("last"))
            .select("id", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))).alias("date")))

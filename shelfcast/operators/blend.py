"""Merging forecasts and blending them per demand class."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.scoring import last_days

# Forecasts blended per class, and the stand-ins for a class without weights.
AVAILABILITY = {
    "Smooth": ["lgbm_point", "prophet_point", "sarima_point", "lstm_point"],
    "Erratic": ["lgbm_point", "prophet_point", "lstm_point"],
    "Intermittent": ["lgbm_point", "dual_point"],
    "Lumpy": ["lgbm_point", "dual_point"],
}
STAND_INS = ["lgbm_point", "dual_point", "prophet_point"]


def active_ids(preds: dict[str, DataFrame]) -> DataFrame:
    """Series with a forecast in any table."""
    return reduce(lambda a, b: a.unionByName(b), [p.select("id").distinct() for p in preds.values()]).distinct()


def merge_predictions(master: DataFrame, preds: dict[str, DataFrame], classes: DataFrame, since=None, until=None,
                      ids: list[str] | None = None) -> DataFrame:
    """Actuals of the active series with each forecast column and the demand class.

    ``preds`` maps a forecast column to its table.  Every left join is on (id, date), so
    the actuals are exchanged once and each forecast table once.  Only days after ``since``, up to
    ``until``, and only the series ``ids`` are read, where given: the bounds reach every scan.
    """
    bounds = [c for c in (None if since is None else F.col("date") > F.lit(since), None if until is None else F.col("date") <= F.lit(until),
                          F.col("id").isin(ids) if ids else None) if c is not None]

    def cut(df: DataFrame) -> DataFrame:
        return reduce(DataFrame.filter, bounds, df)

    preds = {column: cut(table) for column, table in preds.items()}
    merged = (cut(master).join(active_ids(preds), "id", "left_semi")
              .select("id", "date", F.col("sales").alias("actual")))
    for column, table in preds.items():
        merged = merged.join(table.select("id", "date", column), ["id", "date"], "left")
    return merged.join(classes.select("id", "demand_class"), "id", "left")


def _columns(merged: DataFrame) -> dict[str, list[str]]:
    """Forecast columns per class that the frame has."""
    have = {k: [c for c in cols if c in merged.columns] for k, cols in AVAILABILITY.items()}
    return {k: cols for k, cols in have.items() if cols}


def blend_gram(merged: DataFrame, start=None, days: int = 56) -> DataFrame:
    """Per class: complete rows, products of forecasts, and products with the actual.

    Rows (demand_class, n_rows, x, y, value); ``y`` is a forecast column or ``actual``.
    All sums of all classes come from one aggregate with map-side partial sums, so a
    class that holds most rows costs no more than any other.
    """
    recent = last_days(merged, days) if start is None else merged.filter(F.col("date") > F.lit(start))
    plan = _columns(merged)
    names = sorted({c for cols in plan.values() for c in cols})
    complete = reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.col("demand_class") == klass)
        for klass, cols in plan.items()])
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]] + [(x, "actual") for x in names]
    sums = [F.sum(F.col(x).cast("double") * F.col(y).cast("double")).alias(f"s{i}") for i, (x, y) in enumerate(pairs)]
    wide = (recent.filter(F.col("actual").isNotNull() & complete).groupBy("demand_class")
            .agg(F.count(F.lit(1)).alias("n_rows"), *sums))
    served = reduce(lambda acc, kv: acc.when(F.col("demand_class") == kv[0], F.array(*[F.lit(c) for c in kv[1]])),
                    list(plan.items())[1:],
                    F.when(F.col("demand_class") == next(iter(plan)), F.array(*[F.lit(c) for c in next(iter(plan.values()))])))
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"s{i}").alias("value"))
                                for i, (x, y) in enumerate(pairs)]))
    return (
        wide.select("demand_class", "n_rows", served.alias("served"), cells.alias("c"))
        .filter(F.array_contains("served", F.col("c.x"))
                & ((F.col("c.y") == "actual") | F.array_contains("served", F.col("c.y"))))
        .select("demand_class", "n_rows", "c.*")
    )


def nonnegative_ridge(gram: np.ndarray, target: np.ndarray, alpha: float) -> np.ndarray:
    """Exact minimum of a ridge loss over weights >= 0, by trying the active sets."""
    n = len(target)
    full = gram + alpha * np.eye(n)
    for size in range(n, 0, -1):
        for free in combinations(range(n), size):
            pick = list(free)
            inner = np.linalg.solve(full[np.ix_(pick, pick)], target[pick])
            if (inner <= 0).any():
                continue
            weights = np.zeros(n)
            weights[pick] = inner
            slack = target - full @ weights
            rest = [i for i in range(n) if i not in free]
            if not rest or (slack[rest] <= 1e-9 * np.abs(target).max()).all():
                return weights
    return np.zeros(n)


def ensemble_weights(gram: DataFrame, alpha: float = 1.0, min_rows: int = 100) -> DataFrame:
    """Weights (demand_class, model, weight) that sum to 1 per class, 4 places.

    ``gram`` has at most 56 rows (four classes of up to four columns), already summed;
    each class is solved on its own.  Classes with fewer than ``min_rows`` get none.
    """
    def solve(cells: pd.DataFrame) -> pd.DataFrame:
        names = sorted(cells["x"].unique())
        at = {name: i for i, name in enumerate(names)}
        matrix, target = np.zeros((len(names), len(names))), np.zeros(len(names))
        for x, y, value in zip(cells["x"], cells["y"], cells["value"]):
            if y == "actual":
                target[at[x]] = value
            else:
                matrix[at[x], at[y]] = matrix[at[y], at[x]] = value
        weights = nonnegative_ridge(matrix, target, alpha)
        total = weights.sum()
        shares = weights / total if total > 0 else weights
        return pd.DataFrame({"demand_class": cells["demand_class"].iloc[0], "model": names, "weight": shares})

    return (
        gram.filter(F.col("n_rows") >= min_rows)
        .groupBy("demand_class").applyInPandas(solve, "demand_class string, model string, weight double")
        .withColumn("weight", F.round("weight", 4))
    )


def apply_blend(merged: DataFrame, weights: DataFrame) -> DataFrame:
    """Adds ``ensemble_point``; rows without a known class are dropped.

    Weights become one row per class (at most four), which is safe to broadcast.  Their total is
    cut to their 4 places, so no order of addition shows in it.  A share is rounded in thousandths:
    a sum one bit below a half (2660.7935, added up to 2660.79349...) is that half once scaled, and goes up.
    """
    names = sorted({c for cols in AVAILABILITY.values() for c in cols if c in merged.columns})
    by_class = (weights.filter(F.col("model").isin(names)).groupBy("demand_class")
                .agg(F.round(F.sum("weight"), 4).alias("_total"),
                     *[F.sum(F.when(F.col("model") == c, F.col("weight"))).alias(f"_w_{c}") for c in names]))
    blended = reduce(lambda a, b: a + b, [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.coalesce(F.col(f"_w_{c}"), F.lit(0.0)) for c in names])
    share = F.when(F.col("_total") > 0, blended / F.nullif(F.col("_total"), F.lit(0.0))).otherwise(F.lit(0.0))
    stand_in = next((c for c in STAND_INS if c in merged.columns), None)
    plain = F.lit(None).cast("double") if stand_in is None else F.coalesce(F.col(stand_in).cast("double"), F.lit(0.0))
    point = (F.when(F.col("_total").isNotNull(), F.round(F.greatest(share, F.lit(0.0)) * 1000) / 1000)
             .otherwise(F.greatest(plain, F.lit(0.0))))
    return (
        merged.filter(F.col("demand_class").isin(list(AVAILABILITY)))
        .join(F.broadcast(by_class), "demand_class", "left")
        .select(*[c for c in merged.columns if c != "demand_class"], "demand_class", point.alias("ensemble_point"))
    )

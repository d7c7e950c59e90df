"""Seasonal ARIMA on plain and seasonal differences: two regressions, then conditional least squares.

Spark sums the products each regression needs (Hannan and Rissanen 1982), one row per series; only those rows go
to numpy, which solves a batch of small systems at once.  Orders with moving-average terms are then refined by
Gauss-Newton steps on the recursive shocks, batches of series side by side; a step counts only where it lowers the
sum of squares.  A day without a value counts as 0 where it is a lag.  Series whose system cannot be solved get no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.features import by_series
from shelfcast.operators.reshape import keep_ids
from shelfcast.sources.staging import stage

# Default orders, and the lags of the long autoregression of the first step.
ORDER = (1, 1, 1)
SEASONAL = (1, 0, 1, 7)
LONG_LAGS = 14
# 5 % point of the level test, and the seasonal strength that asks for a seasonal difference.
UNSTEADY, STRONG = 0.463, 0.64
#: Gauss-Newton steps, and series that take them side by side.
ROUNDS, SIDE_BY_SIDE = 10, 128
FIT = T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("sigma2", T.DoubleType())])


def product_lags(order: int, seasonal: int, period: int) -> list[int]:
    """Lags of the product of the short and the seasonal polynomial."""
    short = list(range(order + 1))
    return sorted({s + period * k for s in short for k in range(seasonal + 1)} - {0})


def difference_weights(plain: int, seasonal: int, period: int) -> dict[int, float]:
    """Weights by lag, from 1, of (1 - B)^plain (1 - B^period)^seasonal."""
    weights = np.ones(1)
    for lag in [1] * plain + [period] * seasonal:
        weights = np.convolve(weights, [1.0, *[0.0] * (lag - 1), -1.0])
    return {k: w for k, w in enumerate(weights.tolist()) if k and w}


def _dot(weights: str, values: list[Column]) -> Column:
    total = F.lit(0.0)
    for i, value in enumerate(values):
        total = total + F.col(weights)[i] * F.coalesce(value, F.lit(0.0))
    return total


def _solve_batch(grams: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Solutions of a stack of systems and a mask of those that are well conditioned."""
    if not grams.shape[1]:
        return np.zeros_like(targets), np.ones(len(grams), bool)
    size = np.sqrt(np.abs(np.einsum("nii->ni", grams))).clip(1e-12)
    scaled = grams / size[:, :, None] / size[:, None, :]
    good = np.isfinite(scaled).all(axis=(1, 2)) & (np.linalg.cond(np.nan_to_num(scaled)) < 1e10)
    solved = np.zeros_like(targets)
    if good.any():
        solved[good] = np.linalg.solve(scaled[good], (targets / size)[good][..., None])[..., 0] / size[good]
    return solved, good


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def long_autoregression(covariances: pd.Series) -> pd.Series:
    """Yule-Walker weights from the sums of lagged products."""
    sums = np.stack(covariances.to_list()).astype(float)
    lags = sums.shape[1] - 1
    toeplitz = sums[:, np.abs(np.subtract.outer(np.arange(lags), np.arange(lags)))]
    solved, good = _solve_batch(toeplitz, sums[:, 1:])
    return pd.Series([w if ok else None for w, ok in zip(solved.tolist(), good)])


def _square(flat: np.ndarray, n: int) -> np.ndarray:
    """Symmetric matrices from the rows of their upper triangles."""
    full = np.zeros((len(flat), n, n))
    upper = np.triu_indices(n)
    full[:, upper[0], upper[1]] = flat
    full[:, upper[1], upper[0]] = flat
    return full


@F.pandas_udf(FIT)
def regression(products: pd.Series, rows: pd.Series) -> pd.DataFrame:
    """Least squares of the first variable on the others, from the sums of products."""
    flat = np.stack(products.to_list()).astype(float)
    n = int((np.sqrt(8 * flat.shape[1] + 1) - 1) / 2)
    full = _square(flat, n)
    beta, good = _solve_batch(full[:, 1:, 1:], full[:, 1:, 0])
    left = np.maximum(full[:, 0, 0] - np.einsum("ni,ni->n", beta, full[:, 1:, 0]), 0)
    sigma2 = left / np.maximum(rows.to_numpy(float) - (n - 1), 1)
    good &= rows.to_numpy() > 2 * n
    return pd.DataFrame({"beta": [b if ok else None for b, ok in zip(beta.tolist(), good)],
                         "sigma2": np.where(good, sigma2, np.nan)})


def _differences(panel: DataFrame, ids: DataFrame | None, taken: dict[int, float], min_rows: int) -> DataFrame:
    """(id, date, y, base, step, rn, n) of the series with enough rows; y is base, the part its past gives, plus step."""
    rows = panel if ids is None else keep_ids(panel, ids)
    y = F.col("sales").cast("double")
    step, base = y, F.lit(0.0)
    for lag, weight in taken.items():
        step = step + F.lit(weight) * F.lag(y, lag).over(by_series())
        base = base - F.lit(weight) * F.coalesce(F.lag(y, lag).over(by_series()), F.lit(0.0))
    return (
        rows.select("id", "date", y.alias("y"), base.alias("base"), step.alias("step"), F.row_number().over(by_series()).alias("rn"),
                    F.count("sales").over(Window.partitionBy("id")).alias("n"))
        .filter(F.col("n") >= min_rows)
    )


def _with_shocks(diffs: DataFrame) -> DataFrame:
    """Adds ``shock``, what a long autoregression leaves of each step."""
    lagged = [F.coalesce(F.lag("step", k).over(by_series()), F.lit(0.0)) for k in range(1, LONG_LAGS + 1)]
    steps = diffs.withColumns({f"l{k}": lag for k, lag in enumerate(lagged, 1)})
    names = [f"l{k}" for k in range(1, LONG_LAGS + 1)]
    products = [F.sum(F.col("step") * F.col("step")), *[F.sum(F.col("step") * F.col(c)) for c in names]]
    weights = (steps.groupBy("id").agg(F.array(*products).alias("sums"))
               .select("id", long_autoregression("sums").alias("pi")).filter(F.col("pi").isNotNull()))
    return (steps.join(weights, "id")
            .select("id", "date", "y", "rn", "n", "step",
                    (F.coalesce("step", F.lit(0.0)) - _dot("pi", [F.col(c) for c in names])).alias("shock")))


def _design(rows: DataFrame, ar: list[int], ma: list[int], lead: int) -> tuple[DataFrame, list[str], int]:
    """Rows with one column per regressor, their names, and the first row number to fit on; ``lead`` rows have no step."""
    if ma:
        rows = _with_shocks(rows)
    cols = {f"a{k}": F.lag("step", k).over(by_series()) for k in ar}
    cols |= {f"m{k}": F.lag("shock", k).over(by_series()) for k in ma}
    first = lead + max([*ar, 0]) + 1
    if ma:
        first = max(first, lead + LONG_LAGS + max(ma) + 1)
    return rows.withColumns(cols), list(cols), first


def _fits(rows: DataFrame, names: list[str], first: int) -> DataFrame:
    variables = ["step", *names]
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(variables) for b in variables[i:]]
    sums = (rows.filter(F.col("rn") >= first).groupBy("id")
            .agg(F.array(*products).alias("products"), F.count(F.lit(1)).alias("rows")))
    return (sums.select("id", regression("products", "rows").alias("fit")).select("id", "fit.*")
            .filter(F.col("beta").isNotNull()))


def _lags(order, seasonal) -> tuple[list[int], list[int], dict[int, float]]:
    """Lags of steps and of shocks, and the weights that make steps."""
    return (product_lags(order[0], seasonal[0], seasonal[3]), product_lags(order[2], seasonal[2], seasonal[3]),
            difference_weights(order[1], seasonal[1], seasonal[3]))


# ---- conditional least squares -----------------------------------------------------------

def _later(values: np.ndarray, lag: int) -> np.ndarray:
    """``values`` (days first) moved ``lag`` days on, zeros before."""
    out = np.zeros_like(values)
    out[lag:] = values[:max(0, len(values) - lag)]
    return out


def shocks(step: np.ndarray, seen: np.ndarray, ar: list[int], ma: list[int], beta: np.ndarray, slopes: bool = False) -> np.ndarray:
    """(day, series, 1 or 1 + weights): each day's shock, 0 where it is not ``seen``, and its slopes by the weights of ``beta``."""
    lagged = [_later(step, k) for k in ar]
    out = np.zeros((*step.shape, 1 + (beta.shape[1] if slopes else 0)))
    out[:, :, 0] = step - sum((beta[:, i] * x for i, x in enumerate(lagged)), np.zeros_like(step))
    for i, x in enumerate(lagged if slopes else []):
        out[:, :, 1 + i] = -x
    for day in range(len(step)):
        for j, k in enumerate(ma):
            if day >= k:
                if slopes:
                    out[day, :, 1 + len(ar) + j] -= out[day - k, :, 0]
                out[day] -= beta[:, len(ar) + j, None] * out[day - k]
        out[day] *= seen[day, :, None]
    return out


def refine(step: np.ndarray, seen: np.ndarray, ar: list[int], ma: list[int], beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights whose sum of squared shocks is not above that of ``beta``, and that sum, per series."""
    def sums(weights):
        out = shocks(step, seen, ar, ma, weights, slopes=True)
        both = np.einsum("dsa,dsb->sab", out, out, optimize=True)
        return both[:, 0, 0], both[:, 1:, 0], both[:, 1:, 1:]

    with np.errstate(all="ignore"):  # shocks of weights that cannot be inverted grow beyond bounds
        # The regressions may leave such weights; smaller ones are then the better start.
        starts = [beta * np.where(np.arange(beta.shape[1]) < len(ar), 1.0, shrink) for shrink in (1.0, 0.5, 0.0)]
        squares = np.stack([(shocks(step, seen, ar, ma, b) ** 2).sum(axis=(0, 2)) for b in starts])
        beta = np.stack(starts)[np.where(np.isfinite(squares), squares, np.inf).argmin(axis=0), np.arange(len(beta))]
        least, slope, curve = sums(beta)
        damp = np.full(len(beta), 1e-3)
        for _ in range(ROUNDS):
            move, _ = _solve_batch(curve * (1 + damp[:, None, None] * np.eye(beta.shape[1])), -slope)
            trial = beta + move
            square, new_slope, new_curve = sums(trial)
            better = square < least
            beta, least = np.where(better[:, None], trial, beta), np.where(better, square, least)
            slope, curve = np.where(better[:, None], new_slope, slope), np.where(better[:, None, None], new_curve, curve)
            damp = np.where(better, damp / 10, damp * 10)
    return beta, least


def _tracks(ar: list[int], ma: list[int], lead: int):
    """A function of one row per series: its refined fit, and each day's shock and the step its past gives."""
    doubles = T.ArrayType(T.DoubleType())
    out = T.StructType([*FIT.fields, T.StructField("shock", doubles), T.StructField("ahead", doubles)])

    def follow(steps: pd.Series, beta: pd.Series, sigma2: pd.Series) -> pd.DataFrame:
        size = steps.map(len).to_numpy()
        step = np.full((size.max(), len(steps)), np.nan)
        for i, own in enumerate(steps):
            step[:size[i], i] = own
        seen = np.isfinite(step)
        seen[:lead + max([*ar, 0])] = False
        step = np.nan_to_num(step)
        weights, left = np.stack(beta.to_list()).astype(float), sigma2.to_numpy(float)
        if ma:
            weights, squares = refine(step, seen, ar, ma, weights)
            left = squares / np.maximum(seen.sum(axis=0) - weights.shape[1], 1)
        shock = shocks(step, seen, ar, ma, weights)[:, :, 0]
        ahead = sum((weights[:, i] * _later(step, k) for i, k in enumerate(ar)), np.zeros_like(step))
        ahead = ahead + sum((weights[:, len(ar) + j] * _later(shock, k) for j, k in enumerate(ma)), np.zeros_like(step))
        return pd.DataFrame({"beta": list(weights), "sigma2": left, "shock": [shock[:n, i] for i, n in enumerate(size)],
                             "ahead": [ahead[:n, i] for i, n in enumerate(size)]})

    @F.pandas_udf(out)
    def track(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            parts = [follow(*(c.iloc[a:a + SIDE_BY_SIDE] for c in columns)) for a in range(0, len(columns[0]), SIDE_BY_SIDE)]
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=out.names)

    return track


def fitted_series(panel: DataFrame, ids: DataFrame | None = None, order=ORDER, seasonal=SEASONAL, min_rows: int = 60) -> DataFrame:
    """(id, days, fit) per series: its days (rn, date, y, base, step) in order, and beta, sigma2, shock and ahead of the fit."""
    ar, ma, taken = _lags(order, seasonal)
    lead = max(taken, default=0)
    steps = _differences(panel, ids, taken, min_rows)
    rows, names, first = _design(steps, ar, ma, lead)
    # A series has one row per day, so its list is as long as the calendar at most.
    series = steps.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rn", "date", "y", "base", "step"))).alias("days"))
    return (series.join(_fits(rows, names, first), "id")
            .select("id", "days", _tracks(ar, ma, lead)("days.step", "beta", "sigma2").alias("fit")))


def seasonal_arima(panel: DataFrame, ids: DataFrame | None = None, order=ORDER, seasonal=SEASONAL,
                   min_rows: int = 60) -> DataFrame:
    """One-step forecasts (id, date, sarima_point) of every day of each series, not below 0."""
    found = fitted_series(panel, ids, order, seasonal, min_rows)
    return (found.select("id", F.explode(F.arrays_zip(F.col("days").alias("day"), F.col("fit.ahead").alias("ahead"))).alias("at"))
            .select("id", "at.day.date", F.greatest(F.col("at.day.base") + F.col("at.ahead"), F.lit(0.0)).alias("sarima_point")))


def _path(ar: list[int], ma: list[int], taken: dict[int, float], horizon: int):
    """A function of one row per series that extends it by ``horizon`` days."""
    out = T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("point", "lower", "upper")]))
    kept = max([*ar, *ma, *taken, 1])

    def tails(values: pd.Series) -> np.ndarray:
        """The last days of each series, zeros before short ones, and room for the days ahead."""
        track = np.zeros((len(values), kept + horizon))
        for i, own in enumerate(values):
            last = np.nan_to_num(np.asarray(own, float)[-kept:])
            track[i, kept - len(last):kept] = last
        return track

    @F.pandas_udf(out)
    def extend(levels: pd.Series, steps: pd.Series, noise: pd.Series, beta: pd.Series, sigma2: pd.Series) -> pd.Series:
        weights = np.stack(beta.to_list()).astype(float)
        level, track, known = tails(levels), tails(steps), tails(noise)
        psi, rise = np.zeros((len(level), horizon)), np.zeros((len(level), horizon))
        for h in range(horizon):
            at = kept + h
            track[:, at] = (sum(weights[:, i] * track[:, at - k] for i, k in enumerate(ar))
                            + sum(weights[:, len(ar) + i] * known[:, at - k] for i, k in enumerate(ma)))
            level[:, at] = track[:, at] - sum(w * level[:, at - k] for k, w in taken.items())
            psi[:, h] = 1.0 if h == 0 else (
                sum(weights[:, i] * psi[:, h - k] for i, k in enumerate(ar) if k <= h)
                + sum(weights[:, len(ar) + i] for i, k in enumerate(ma) if k == h))
            rise[:, h] = psi[:, h] - sum(w * rise[:, h - k] for k, w in taken.items() if k <= h)
        point = level[:, kept:]
        spread = 1.959964 * np.sqrt((rise ** 2).cumsum(axis=1) * sigma2.to_numpy(float)[:, None])
        lower, upper = np.maximum(point - spread, 0), np.maximum(point + spread, 0)
        point = np.maximum(point, 0)
        return pd.Series([[{"point": p, "lower": lo, "upper": up} for p, lo, up in zip(*three)]
                          for three in zip(point.tolist(), lower.tolist(), upper.tolist())])

    return extend


def seasonal_arima_forecast(panel: DataFrame, ids: DataFrame | None = None, horizon: int = 28, order=ORDER,
                            seasonal=SEASONAL, min_rows: int = 60) -> DataFrame:
    """The next days (id, date, sarima_point, sarima_lower, sarima_upper) with 95 % bounds."""
    path = _path(*_lags(order, seasonal), horizon)("days.y", "days.step", "fit.shock", "fit.beta", "fit.sigma2")
    return (
        fitted_series(panel, ids, order, seasonal, min_rows)
        .select("id", F.element_at("days.date", -1).alias("last"), F.posexplode(path).alias("at", "f"))
        .select("id", F.date_add("last", F.col("at") + 1).alias("date"), F.col("f.point").alias("sarima_point"),
                F.col("f.lower").alias("sarima_lower"), F.col("f.upper").alias("sarima_upper"))
    )


def order_search(panel: DataFrame, ids: DataFrame | None = None, p_range=range(3), q_range=range(3),
                 seasonal=SEASONAL, min_rows: int = 60, plain: int = 1) -> DataFrame:
    """Mean AIC per (p, q) over the series of ``ids``, of ``plain`` and seasonal differences; ``best`` marks the lowest.

    Every order reads its part of one table of sums, so the panel is read once for all.
    """
    widest_ar = product_lags(max(p_range), seasonal[0], seasonal[3])
    widest_ma = product_lags(max(q_range), seasonal[2], seasonal[3])
    taken = difference_weights(plain, seasonal[1], seasonal[3])
    rows, names, first = _design(_differences(panel, ids, taken, min_rows), widest_ar, widest_ma, max(taken, default=0))
    grid = [(p, q, [names.index(f"a{k}") + 1 for k in product_lags(p, seasonal[0], seasonal[3])]
             + [names.index(f"m{k}") + 1 for k in product_lags(q, seasonal[2], seasonal[3])])
            for p in p_range for q in q_range]
    out = T.ArrayType(T.StructType([T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()),
                                    T.StructField("aic", T.DoubleType())]))

    @F.pandas_udf(out)
    def information(products: pd.Series, count: pd.Series) -> pd.Series:
        full = _square(np.stack(products.to_list()).astype(float), len(names) + 1)
        seen = count.to_numpy(float)
        scores = []
        for p, q, pick in grid:
            target = full[:, pick, 0]
            beta, good = _solve_batch(full[:, pick][:, :, pick], target)
            left = full[:, 0, 0] - (beta * target).sum(axis=1)
            good &= left > 0
            aic = seen * np.log(np.where(good, left, 1.0) / seen) + 2 * (len(pick) + 1)
            scores.append([{"p": p, "q": q, "aic": a if ok else None} for a, ok in zip(aic.tolist(), good)])
        return pd.Series([list(row) for row in zip(*scores)])

    variables = ["step", *names]
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(variables) for b in variables[i:]]
    sums = (rows.filter(F.col("rn") >= first).groupBy("id")
            .agg(F.array(*products).alias("products"), F.count(F.lit(1)).alias("rows")))
    scored = (sums.select(F.explode(information("products", "rows")).alias("s")).select("s.*")
              .groupBy("p", "q").agg(F.avg("aic").alias("mean_aic"), F.count("aic").alias("n_series")))
    best = scored.agg(F.min("mean_aic")).scalar()
    return scored.withColumn("best", F.col("mean_aic") == best)


def best_order(panel: DataFrame, ids: DataFrame | None = None, seasonal=SEASONAL, plain: int = ORDER[1]) -> tuple[int, int, int]:
    """The order with the lowest mean AIC at these differences; the smallest of equal ones."""
    row = order_search(panel, ids, seasonal=seasonal, plain=plain).where("best").orderBy("p", "q").first()
    return (row["p"], plain, row["q"]) if row else (ORDER[0], plain, ORDER[2])


# ---- differences per series --------------------------------------------------------------

def _level_test(step: str, bandwidth: int) -> tuple[dict[str, Column], dict[str, Column], Column]:
    """Running sums of ``step`` about its mean, those sums so far back, and the test statistic of a series.

    Bartlett's long-run variance is the mean square of sums over ``bandwidth`` + 1 days in a row, zeros around the
    series, so it needs the running sum and the one that many days before, not a column per lag.
    """
    run, before = f"{step}_run", f"{step}_before"
    about = F.col(step) - F.avg(step).over(Window.partitionBy("id"))
    so_far = by_series().rowsBetween(Window.unboundedPreceding, 0)
    sums = {run: F.coalesce(F.sum(about).over(so_far), F.lit(0.0))}
    lagged = {before: F.coalesce(F.lag(run, bandwidth + 1).over(by_series()), F.lit(0.0))}
    square = F.col(run) * F.col(run)
    change = F.col(run) - F.col(before)
    spread = F.sum(change * change) + F.sum(F.when(F.col("rn") >= F.col("n") - bandwidth, square).otherwise(0.0))
    level = F.sum(square) * (bandwidth + 1) / (F.count(step) * spread)
    return sums, lagged, F.when(spread > 0, level).otherwise(0.0)


def difference_orders(panel: DataFrame, ids: DataFrame | None = None, period: int = SEASONAL[3], bandwidth: int = LONG_LAGS,
                      min_rows: int = 60) -> DataFrame:
    """Differences that make each series stationary: (id, n, strength, seasonal, level_0, level_1, plain).

    ``strength`` is the share of the detrended variance that the mean of each day of the period explains (Wang, Smith and
    Hyndman 2006); from ``STRONG`` on, one seasonal difference is taken.  ``level_0`` and ``level_1`` are the statistics
    of Kwiatkowski, Phillips, Schmidt and Shin (1992) of what is left and of its steps; each above ``UNSTEADY`` asks for one more
    plain difference.  Days without a value are left out; series of fewer than ``min_rows`` get no row; a series that
    does not vary has statistics of 0.  The test misses part of the unsteady series that have few days: of six random walks
    of 420 days it found four.  All windows share one exchange on ``id``.
    """
    whole = Window.partitionBy("id")
    around = by_series().rowsBetween(-(period // 2), period - 1 - period // 2)
    rows = (panel if ids is None else keep_ids(panel, ids)).filter(F.col("sales").isNotNull())
    rows = rows.select("id", "date", F.col("sales").cast("double").alias("y"), F.row_number().over(by_series()).alias("rn"),
                       F.count(F.lit(1)).over(whole).alias("n")).filter(F.col("n") >= min_rows)
    rows = (
        rows.withColumn("free", F.when(F.count("y").over(around) == period, F.col("y") - F.avg("y").over(around)))
        .withColumn("rest", F.col("free") - F.avg("free").over(Window.partitionBy("id", F.col("rn") % period)))
        .withColumns({"all_of": F.var_pop("free").over(whole), "rest_of": F.var_pop("rest").over(whole)})
        .withColumn("strength", F.when(F.col("all_of") > 0, F.greatest(F.lit(0.0), 1 - F.col("rest_of") / F.col("all_of"))).otherwise(0.0))
        .withColumn("s0", F.when(F.col("strength") >= STRONG, F.col("y") - F.lag("y", period).over(by_series())).otherwise(F.col("y")))
        .withColumn("s1", F.col("s0") - F.lag("s0").over(by_series()))
    )
    (sums_0, back_0, level_0), (sums_1, back_1, level_1) = _level_test("s0", bandwidth), _level_test("s1", bandwidth)
    tested = (rows.withColumns(sums_0 | sums_1).withColumns(back_0 | back_1).groupBy("id")
              .agg(F.max("n").alias("n"), F.max("strength").alias("strength"), level_0.alias("level_0"), level_1.alias("level_1")))
    plain = F.when(F.col("level_0") <= UNSTEADY, 0).when(F.col("level_1") <= UNSTEADY, 1).otherwise(2)
    return tested.select("id", "n", "strength", (F.col("strength") >= STRONG).cast("int").alias("seasonal"),
                         "level_0", "level_1", plain.alias("plain"))


def orders_by_class(panel: DataFrame, tested: DataFrame, seasonal=SEASONAL) -> list[tuple[tuple, tuple]]:
    """The two orders of each class of differences in ``tested``, at most six.

    AIC compares fits of the same differences only, so every class has its own search over p and q.
    """
    found = tested.select("plain", "seasonal").distinct().orderBy("plain", "seasonal").collect()
    out = []
    for d, s in found:
        own = (seasonal[0], s, *seasonal[2:])
        out.append((best_order(panel, tested.filter((F.col("plain") == d) & (F.col("seasonal") == s)).select("id"), own, d), own))
    return out


def searched_arima(panel: DataFrame, ids: DataFrame | None = None, seasonal=SEASONAL, min_rows: int = 60) -> DataFrame:
    """One-step forecasts as :func:`seasonal_arima`, each series with the differences its tests ask for and the order of its class."""
    tested = stage(difference_orders(panel, ids, seasonal[3], min_rows=min_rows), "differences")
    out = None
    for order, own in orders_by_class(panel, tested, seasonal):
        members = tested.filter((F.col("plain") == order[1]) & (F.col("seasonal") == own[1])).select("id")
        part = seasonal_arima(panel, members, order, own, min_rows)
        out = part if out is None else out.unionByName(part)
    return seasonal_arima(panel, ids, ORDER, seasonal, min_rows) if out is None else out

"""Boosted trees over the feature table: point forecast, quantile band, importances."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.boosting import Forest, boost, permutation_importance
from shelfcast.operators.features import CATEGORY_COLS, MODEL_COLS
from shelfcast.operators.reshape import scan_features, time_split
from shelfcast.sources.staging import stage
from shelfcast.sources.store import TableStore

# Quantiles, most rounds, patience, leaves of a tree and smallest leaf.
QUANTILES = (0.1, 0.5, 0.9)
ROUNDS, PATIENCE = 1000, 50
LEAVES, LEAF_ROWS = 127, 20
CODE_ROWS = 20.0


@dataclass
class Codes:
    """Mean sales per value of each category column, and the overall mean for new values.

    ``table`` has rows (category, value, code).
    """

    table: DataFrame
    prior: float

    def save(self, store: TableStore) -> None:
        store.replace("codes", self.table.withColumn("prior", F.lit(self.prior)).unionByName(self.table.sparkSession.createDataFrame(
            [(None, None, None, self.prior)], "category string, value string, code double, prior double")))

    @staticmethod
    def load(store: TableStore) -> Codes:
        rows = store.read("codes")
        return Codes(rows.where("category IS NOT NULL").drop("prior"), rows.where("category IS NULL").first()["prior"])


def fit_codes(train: DataFrame) -> Codes:
    """Category codes from training rows: one pass to a row per series, then sums over those."""
    per_series = stage(train.groupBy("id", *CATEGORY_COLS).agg(
        F.sum(F.col("sales").cast("double")).alias("total"), F.count(F.lit(1)).alias("rows")), "series_totals")
    prior = float(per_series.agg(F.sum("total") / F.nullif(F.sum("rows"), F.lit(0))).first()[0] or 0.0)
    mean = (F.sum("total") + prior * CODE_ROWS) / (F.sum("rows") + CODE_ROWS)
    codes = (per_series.unpivot(["total", "rows"], CATEGORY_COLS, "category", "value")
             .groupBy("category", "value").agg(mean.alias("code")))
    return Codes(stage(codes, "codes"), prior)


def with_codes(rows: DataFrame, codes: Codes) -> DataFrame:
    """Adds the codes.  Values are looked up per series, so a common item is no hot key."""
    series = rows.select("id", *CATEGORY_COLS).distinct()
    for name in CATEGORY_COLS:
        known = codes.table.filter(F.col("category") == name).select(F.col("value").alias(name), F.col("code").alias(f"{name}_code"))
        series = series.join(known, name, "left")
    coded = series.select("id", *[F.coalesce(f"{c}_code", F.lit(codes.prior)).alias(f"{c}_code") for c in CATEGORY_COLS])
    return rows.join(coded, "id")


def model_matrix(features: DataFrame, codes: Codes | None = None, ids: DataFrame | None = None,
                 val_days: int | None = None) -> tuple[DataFrame, Codes, list[str]]:
    """Rows (id, date, sales, is_val, features), the codes used, and the feature names.

    Without ``codes`` they are fitted on the rows before validation.
    """
    rows = scan_features(features, MODEL_COLS, ids)
    if val_days is not None:
        rows = time_split(rows, val_days)
    if codes is None:
        codes = fit_codes(rows.filter(~F.col("is_val")) if val_days is not None else rows)
    numbers = [c for c in MODEL_COLS if c in rows.columns and c not in CATEGORY_COLS]
    names = [f"{c}_code" for c in CATEGORY_COLS] + numbers
    flat = with_codes(rows, codes).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers})
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(flat)
    kept = ["id", "date", F.col("sales").cast("double").alias("sales"), "features"]
    return vectors.select(*kept, *(["is_val"] if val_days is not None else [])), codes, names


@dataclass
class Boosted:
    """Trees of the point forecast, and of each quantile of the band if it has one."""

    forest: Forest
    codes: Codes

    def save(self, path: str) -> None:
        store = TableStore(self.codes.table.sparkSession, path)
        self.codes.save(store)
        self.forest.save(store, "forest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        store = TableStore(spark, path)
        return Boosted(Forest.load(store, "forest"), Codes.load(store))


def fit_boosted(features: DataFrame, ids: DataFrame | None = None, val_days: int = 28, rounds: int = ROUNDS, patience: int = PATIENCE,
                leaves: int = LEAVES, seed: int = 42, quantiles: tuple[float, ...] | None = QUANTILES, path: str | None = None) -> Boosted:
    """Absolute error for the point and a pinball loss per quantile, each kept up to its best round; ``path`` as in :func:`boost`."""
    matrix, codes, names = model_matrix(features, None, ids, val_days)
    forest = boost(stage(matrix, "matrix"), names, "sales", [0.5, *(quantiles or ())], rounds, patience, leaves, LEAF_ROWS, seed, path)
    return Boosted(forest.best(), codes)


def leaf_quantiles(rows: DataFrame, keys: list[str], quantiles=QUANTILES, value: str = "sales") -> DataFrame:
    """Exact interpolated quantiles per key from counts of distinct values."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    levels = F.percentile(value, F.array(*[F.lit(float(q)) for q in quantiles]), F.col("n"))
    return counts.groupBy(*keys).agg(levels.alias("levels")).select(
        *keys, *[F.col("levels")[i].alias(f"q{round(q * 100)}") for i, q in enumerate(quantiles)])


def predict_boosted(model: Boosted, features: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(id, date, lgbm_point, lgbm_q..) for every row with the longest lag; not below 0, 3 places, quantiles in order."""
    matrix, _, _ = model_matrix(features, model.codes, ids)
    found = model.forest.predict(matrix, ["id", "date"])
    quantiles = sorted(q for q in model.forest.losses[1:])
    levels = F.array_sort(F.slice("margins", 2, len(quantiles))) if quantiles else None

    def clean(c):
        return F.round(F.greatest(c, F.lit(0.0)), 3)

    return found.select("id", "date", clean(F.col("margins")[0]).alias("lgbm_point"),
                        *[clean(levels[i]).alias(f"lgbm_q{round(q * 100)}") for i, q in enumerate(quantiles)])


def feature_importance(model: Boosted, features: DataFrame, n: int = 20, ids: DataFrame | None = None, val_days: int = 28) -> DataFrame:
    """The ``n`` features of the model whose permutation raises the point's validation error most."""
    matrix, _, _ = model_matrix(features, model.codes, ids, val_days)
    rows = matrix.where("is_val").withColumnRenamed("sales", "y")
    return permutation_importance(features.sparkSession, model.forest, rows).orderBy(F.col("importance").desc(), "feature").limit(n)

"""Two-part forecast for sparse series: chance of a sale times size of a sale."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.boosted import Codes, model_matrix
from shelfcast.operators.boosting import Forest, boost
from shelfcast.operators.reshape import last_n_per_series
from shelfcast.operators.scoring import auc, last_days
from shelfcast.sources.staging import stage
from shelfcast.sources.store import TableStore

# Most rounds, patience, leaves, and the smallest leaves of the chance and the size model.
ROUNDS, PATIENCE, LEAVES, CHANCE_LEAF_ROWS, SIZE_LEAF_ROWS = 500, 30, 63, 10, 5


@dataclass
class Dual:
    """``occurrence`` is None when every training row had the same outcome, ``always``."""

    occurrence: Forest | None
    magnitude: Forest | None
    codes: Codes
    always: float = 0.0

    def save(self, path: str) -> None:
        spark = self.codes.table.sparkSession
        store = TableStore(spark, path)
        self.codes.save(store)
        parts = [(f.dump() if f is not None else None) for f in (self.occurrence, self.magnitude)]
        store.replace("parts", spark.createDataFrame([(*parts, self.always)], "occurrence string, magnitude string, always double"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Dual:
        store = TableStore(spark, path)
        parts = store.read("parts").first()
        return Dual(*[Forest.parse(parts[c]) if parts[c] else None for c in ("occurrence", "magnitude")], Codes.load(store), parts["always"])


def fit_dual(features: DataFrame, ids: DataFrame | None = None, val_days: int = 28, rounds: int = ROUNDS, patience: int = PATIENCE,
             leaves: int = LEAVES, seed: int = 42) -> Dual:
    """The size model learns from rows with a sale only."""
    matrix, codes, names = model_matrix(features, None, ids, val_days)
    matrix = stage(matrix.withColumn("sold", (F.col("sales") > 0).cast("double")), "dual_matrix")
    outcomes = {r["sold"] for r in matrix.filter(~F.col("is_val")).select("sold").distinct().collect()}
    if not outcomes:
        return Dual(None, None, codes)
    occurrence = magnitude = None
    if len(outcomes) == 2:
        occurrence = boost(matrix, names, "sold", [None], rounds, patience, leaves, CHANCE_LEAF_ROWS, seed).best()
    if 1.0 in outcomes:
        magnitude = boost(matrix.filter("sold = 1"), names, "sales", [0.5], rounds, patience, leaves, SIZE_LEAF_ROWS, seed).best()
    return Dual(occurrence, magnitude, codes, max(outcomes))


def product(rows: DataFrame, chance: Column, size: Column) -> DataFrame:
    """(id, date, dual_occurrence_prob, dual_magnitude, dual_point); the product is of unrounded parts."""
    size = F.greatest(size, F.lit(0.0))
    return rows.select("id", "date", F.round(chance, 4).alias("dual_occurrence_prob"),
                       F.round(size, 3).alias("dual_magnitude"), F.round(chance * size, 3).alias("dual_point"))


def predict_dual(model: Dual, features: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The product of both models for every row with the longest lag."""
    rows, _, _ = model_matrix(features, model.codes, ids)
    chance, size = F.lit(model.always), F.lit(0.0)
    if model.occurrence is not None:
        rows = model.occurrence.predict(rows, ["id", "date", "features"]).withColumnRenamed("margins", "_chance")
        chance = 1 / (1 + F.exp(-F.col("_chance")[0]))
    if model.magnitude is not None:
        rows = model.magnitude.predict(rows, [c for c in rows.columns if c in ("id", "date", "_chance")]).withColumnRenamed("margins", "_size")
        size = F.col("_size")[0]
    return product(rows, chance, size)


def dual_forecast(model: Dual, features: DataFrame, ids: DataFrame | None = None, horizon: int = 28) -> DataFrame:
    """The newest ``horizon`` predictions of each series, standing in for the days ahead."""
    return last_n_per_series(predict_dual(model, features, ids), horizon)


def occurrence_auc(preds: DataFrame, master: DataFrame, val_days: int = 28) -> DataFrame:
    """Ranking quality of the chance of a sale over the validation days."""
    joined = last_days(preds, val_days).join(master.select("id", "date", "sales"), ["id", "date"])
    return auc(joined.select(F.col("dual_occurrence_prob").alias("score"), (F.col("sales") > 0).cast("int").alias("label")))

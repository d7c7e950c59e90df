"""The tables of one run over a folder of benchmark tables, each built on first use."""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.baselines import feature_forecasts
from shelfcast.operators.blend import apply_blend, blend_gram, ensemble_weights, merge_predictions
from shelfcast.operators.classify import classify_demand, model_routing
from shelfcast.operators.features import add_demand, add_lags, add_rolling, build_features
from shelfcast.operators.reshape import build_master
from shelfcast.sources import testbed
from shelfcast.sources.staging import stage


class Tables:
    """Nothing is shared between instances: every query builds from the given files.

    Tables read by several later steps are staged; the others stay lazy plans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def given(self, name: str) -> DataFrame:
        return testbed.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> testbed.Raw:
        return testbed.raw_tables(self.spark, self.sf_dir)

    @cached_property
    def master(self) -> DataFrame:
        return build_master(self.raw.sales, self.raw.calendar, self.raw.prices)

    @cached_property
    def core(self) -> DataFrame:
        """What forecasts, blends and scores read, staged once for their many scans."""
        rows = self.master.select(*testbed.IDS, "date", "sales", "sell_price")
        return stage(add_demand(add_rolling(add_lags(rows))), "core")

    @cached_property
    def panel(self) -> DataFrame:
        """Series, day and sales only, for the models that need no features."""
        return stage(self.raw_panel, "panel")

    @cached_property
    def raw_panel(self) -> DataFrame:
        return self.master.select("id", "date", "sales")

    @cached_property
    def features(self) -> DataFrame:
        return build_features(self.master)

    @cached_property
    def staged_features(self) -> DataFrame:
        return stage(self.features, "features")

    @cached_property
    def classes(self) -> DataFrame:
        rows = self.core if "core" in self.__dict__ else self.master
        return stage(classify_demand(rows), "demand_classes")

    @cached_property
    def routing(self) -> DataFrame:
        return model_routing(self.classes)

    @cached_property
    def preds(self) -> dict[str, DataFrame]:
        """Forecast tables of all model slots, over one staged table."""
        return feature_forecasts(self.core, self.classes)

    @cached_property
    def quantiles(self) -> DataFrame:
        return self.preds["lgbm_point"]

    @cached_property
    def points(self) -> dict[str, DataFrame]:
        return {c: p.select("id", "date", c) for c, p in self.preds.items()}

    @cached_property
    def merged(self) -> DataFrame:
        return stage(merge_predictions(self.core, self.points, self.classes), "merged")

    @cached_property
    def recent(self) -> DataFrame:
        """The newest 58 days of the merge: two report windows, and what the weights are fitted on."""
        newest = self.core.agg(F.max("date")).first()[0]
        return stage(merge_predictions(self.core, self.points, self.classes, since=newest - timedelta(58)), "recent")

    @cached_property
    def gram(self) -> DataFrame:
        return blend_gram(self.recent)

    @cached_property
    def weights(self) -> DataFrame:
        return stage(ensemble_weights(self.gram), "weights")

    @cached_property
    def blended(self) -> DataFrame:
        return apply_blend(self.merged, self.weights)

    @cached_property
    def blended_recent(self) -> DataFrame:
        return apply_blend(self.recent, self.weights)

    def blended_series(self, series_id: str, start: str, end: str) -> DataFrame:
        """One series between two dates, read and merged alone."""
        part = merge_predictions(self.core, self.points, self.classes, date.fromisoformat(start) - timedelta(1),
                                 date.fromisoformat(end), [series_id])
        return apply_blend(part, self.weights)

    @cached_property
    def activity(self) -> DataFrame:
        """The event panel in the shape of a master table."""
        demand = stage(testbed.daily_activity(self.spark, self.sf_dir), "daily_activity")
        return testbed.fill_days(demand).withColumn("sell_price", F.lit(0.0))

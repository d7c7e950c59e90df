"""The three jobs: raw files to features and classes, features to forecasts, forecasts to scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.blend import apply_blend, blend_gram, ensemble_weights, merge_predictions
from shelfcast.operators.boosted import fit_boosted, predict_boosted
from shelfcast.operators.classify import cap_routing, classify_demand, model_routing
from shelfcast.operators.decompose import decompose, holiday_days
from shelfcast.operators.dual import fit_dual, predict_dual
from shelfcast.operators.features import build_features
from shelfcast.operators.reshape import build_master, keep_ids, melt_sales, sample_series
from shelfcast.operators.scoring import model_comparison, per_class_metrics
from shelfcast.operators.seasonal_arima import ORDER, SEASONAL, searched_arima, seasonal_arima
from shelfcast.operators.sequence import fit_sequence, predict_sequence
from shelfcast.operators.serving import incomplete_models, prediction_coverage
from shelfcast.sources.raw_files import read_raw
from shelfcast.sources.staging import stage
from shelfcast.sources.store import TableStore

#: Tables of days by series are kept in this order, so a series is in few files.
CLUSTER = ("id", "date")
# Forecast table and column of each model.
MODELS = ["lgbm", "prophet", "sarima", "lstm", "dual"]


def master_from_files(spark: SparkSession, folder: str) -> DataFrame:
    raw = read_raw(spark, folder)
    return build_master(melt_sales(raw.wide_sales), raw.calendar, raw.prices)


def build_tables(store: TableStore, folder: str, force: bool = False, sample: int | None = None,
                 history_days: int = 365) -> None:
    """Writes ``master``, ``features`` (of a sample of series, if asked) and ``demand_classes``."""
    master = store.cached("master", lambda: master_from_files(store.spark, folder), force)
    ids = sample_series(master, sample) if sample else None
    store.replace("features", build_features(master, ids), cluster_by=CLUSTER)
    store.replace("demand_classes", classify_demand(master, history_days))


def predict_one(model: str, features: DataFrame, panel: DataFrame, ids: DataFrame, save_to: str | None = None,
                orders: tuple | str = (ORDER, SEASONAL)) -> DataFrame:
    """Fits one model on the series of ``ids`` and predicts their days.

    ``orders`` are the two orders of the seasonal model, or ``"search"`` for tested differences and the best
    of the order search for each class of them.
    """
    if model == "prophet":
        wanted = keep_ids(panel, ids)
        return decompose(wanted, holiday_days(panel)).drop("trend")
    if model == "sarima":
        return searched_arima(panel, ids) if orders == "search" else seasonal_arima(panel, ids, *orders)
    if model == "lgbm":
        fitted, predict = fit_boosted(features, ids), predict_boosted
    elif model == "lstm":
        fitted, predict = fit_sequence(features, ids), predict_sequence
    else:
        fitted, predict = fit_dual(features, ids), predict_dual
    if save_to:
        fitted.save(f"{save_to}/{model}")
    return predict(fitted, features, ids)


def _routed(routing: DataFrame, model: str) -> DataFrame:
    return routing.filter(F.col("model") == ("dual_phase" if model == "dual" else model)).select("id")


def fit_and_predict(features: DataFrame, panel: DataFrame, classes: DataFrame, models: list[str] = MODELS) -> dict[str, DataFrame]:
    """Staged forecasts per model; a model without series is left out."""
    routing = model_routing(classes)
    done = {}
    for model in models:
        ids = stage(_routed(routing, model), f"ids_{model}")
        if not keep_ids(features, ids).isEmpty():
            done[model] = stage(predict_one(model, features, panel, ids), f"pred_{model}")
    return done


def run_models(store: TableStore, models: list[str] = MODELS, sample: int | None = None,
               skip_existing: bool = False, orders: tuple | str = (ORDER, SEASONAL)) -> DataFrame:
    """Writes a forecast table per model and returns the coverage of all of them."""
    classes, features = store.read("demand_classes"), store.read("features")
    panel = store.read("master").select("id", "date", "sales")
    routing = model_routing(classes)
    if sample:
        routing = stage(cap_routing(routing, sample), "routing")
    if skip_existing:
        open_models = {r["model"] for r in incomplete_models(coverage(store, routing)).collect()}
        models = [m for m in models if ("dual_phase" if m == "dual" else m) in open_models]
    for model in models:
        ids = _routed(routing, model)
        if not keep_ids(features, ids).isEmpty():
            store.replace(f"pred_{model}", predict_one(model, features, panel, ids, f"{store.root}/models", orders), cluster_by=CLUSTER)
    return coverage(store, routing)


def coverage(store: TableStore, routing: DataFrame | None = None) -> DataFrame:
    """State of every forecast table against the routing."""
    routing = model_routing(store.read("demand_classes")) if routing is None else routing
    return prediction_coverage({m: store.read(f"pred_{m}") for m in MODELS if store.exists(f"pred_{m}")}, routing)


def blend(master: DataFrame, preds: dict[str, DataFrame], classes: DataFrame, val_days: int = 28,
          overlap: bool = False) -> tuple[DataFrame, DataFrame]:
    """Blended forecasts and the weights behind them.

    The weights are fitted on the validation days, which no model was trained on; with ``overlap`` on twice as many.
    """
    points = {f"{m}_point": df.select("id", "date", f"{m}_point") for m, df in preds.items()}
    merged = stage(merge_predictions(master, points, classes), "merged")
    weights = stage(ensemble_weights(blend_gram(merged, days=2 * val_days if overlap else val_days)), "weights")
    return apply_blend(merged, weights), weights


def blend_and_score(master: DataFrame, preds: dict[str, DataFrame], classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    blended, _ = blend(master, preds, classes)
    return blended, model_comparison(blended, master)


def run_blend(store: TableStore, evaluate_only: bool = False, val_days: int = 28, overlap: bool = False) -> DataFrame:
    """Blends the forecast tables that exist (or reads the saved blend) and writes the reports."""
    master = store.read("master")
    if not evaluate_only:
        preds = {m: store.read(f"pred_{m}") for m in MODELS if store.exists(f"pred_{m}")}
        if not preds:
            raise FileNotFoundError("no forecast table; run the models first")
        blended, weights = blend(master, preds, store.read("demand_classes"), val_days, overlap)
        store.replace("blend_weights", weights)
        store.replace("pred_ensemble", blended, cluster_by=CLUSTER)
    blended = store.read("pred_ensemble")
    scores = stage(model_comparison(blended, master, val_days), "model_comparison")
    store.report("model_comparison", scores)
    store.report("per_class_metrics", per_class_metrics(blended))
    return scores

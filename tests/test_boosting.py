import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from shelfcast.operators import boosting
from shelfcast.operators.boosting import Forest, Loss, Tree
from shelfcast.sources.store import TableStore

NAMES = ["hour", "price", "noise"]


def rows_of(n, seed=1):
    """Sales that depend on two of three features, with spread that grows with the first; every fourth row is validation."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        x = [r.randint(0, 9), round(r.random(), 3), r.random()]
        out.append((f"s{i % 40}", i // 40, [float(v) for v in x], float(round(5 * x[0] + 20 * (x[1] > 0.5) + r.gauss(0, 1 + x[0]))), i % 4 == 0))
    return out


@pytest.fixture(scope="module")
def matrix(spark):
    frame = spark.createDataFrame(rows_of(4000), "id string, day int, v array<double>, sales double, is_val boolean")
    return frame.select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day")).alias("date"), array_to_vector("v").alias("features"),
                        "sales", (F.col("sales") > 30).cast("double").alias("high"), "is_val").persist()


def test_leaves_hold_the_quantile_of_all_training_rows(spark, matrix, tmp_path, monkeypatch):
    """The first tree of a stored fit: its leaves are recomputed by SQL from the training rows that fall into them."""
    monkeypatch.setattr(boosting, "SAMPLE", 600)
    path = str(tmp_path / "fit")
    forest = boosting.boost(matrix, NAMES, "sales", [0.5, 0.9], 1, 5, 6, 5, path=path)
    train = matrix.where("NOT is_val").select("features", "sales").toPandas()
    codes = forest.codes(np.stack([v.toArray() for v in train["features"]]))
    for k, q in enumerate((0.5, 0.9)):
        tree = forest.trees[k][0]
        leaf, r = tree.leaf(codes), np.round((train["sales"].to_numpy() - forest.start[k]) * boosting.GRID) / boosting.GRID
        found = duckdb.execute("SELECT leaf, quantile_cont(r, ?) FROM (SELECT unnest(?) AS leaf, unnest(?) AS r) GROUP BY leaf", [q, leaf.tolist(), r.tolist()]).fetchall()
        assert len(found) == 6 and all(tree.value[i] == pytest.approx(boosting.STEP * v, abs=1e-9) for i, v in found)
        assert forest.start[k] == np.quantile(train["sales"], q)


def test_losses(matrix):
    """Errors fall, rounds stop with patience, quantiles cover, and the chance is a chance."""
    forest = boosting.boost(matrix, NAMES, "sales", [0.5, 0.1, 0.9], 200, 20, 12, 20)
    for e in forest.errors:
        assert min(e) < 0.6 * e[0]
    best = forest.best()
    assert all(len(t) == int(np.argmin(e)) for t, e in zip(best.trees, best.errors))
    held = best.predict(matrix.where("is_val"), ["sales"]).toPandas()
    margins, sales = np.stack(held["margins"].to_list()), held["sales"].to_numpy()
    assert abs(np.mean((sales >= margins[:, 1]) & (sales <= margins[:, 2])) - 0.8) < 0.05
    assert np.abs(sales - margins[:, 0]).mean() == pytest.approx(2 * min(forest.errors[0]), rel=1e-6)
    chance = boosting.boost(matrix, NAMES, "high", [None], 60, 20, 8, 10).best()
    p = chance.predict(matrix.where("is_val"), ["high"]).toPandas()
    p["p"] = 1 / (1 + np.exp(-np.stack(p["margins"].to_list())[:, 0]))
    assert p.loc[p["high"] == 1, "p"].mean() > 0.75 > 0.25 > p.loc[p["high"] == 0, "p"].mean()


def test_all_rounds_without_validation(matrix):
    forest = boosting.boost(matrix.drop("is_val"), NAMES, "sales", [0.5], 27, 2, 4, 20)
    assert len(forest.trees[0]) == 27 == len(forest.best().trees[0]) and forest.errors == [[]]
    assert not boosting.boost(matrix.limit(0), NAMES, "sales", [0.5], 5, 2, 4, 20).trees[0]


def test_a_killed_fit_goes_on(spark, matrix, tmp_path, monkeypatch):
    """Stopped in its third turn and called again, it ends with the trees of a fit that was not; more rounds only add to them."""
    monkeypatch.setattr(boosting, "TURN", 4)
    path, passes = str(tmp_path / "state"), []
    own = boosting.renewed

    def dies(rows, recent):
        passes.append(len(recent.trees[0]))
        if len(passes) == 3:
            raise RuntimeError("lost")
        return own(rows, recent)

    monkeypatch.setattr(boosting, "renewed", dies)
    with pytest.raises(RuntimeError):
        boosting.boost(matrix, NAMES, "sales", [0.5], 12, 50, 6, 20, path=path)
    assert len(Forest.parse(TableStore(spark, path).read("state").first()["model"]).trees[0]) == 8
    resumed = boosting.boost(matrix, NAMES, "sales", [0.5], 12, 50, 6, 20, path=path)
    assert passes == [4, 4, 4, 4]
    whole = boosting.boost(matrix, NAMES, "sales", [0.5], 12, 50, 6, 20)
    assert resumed.dump() == whole.dump()
    longer = boosting.boost(matrix, NAMES, "sales", [0.5], 16, 50, 6, 20, path=path)
    assert passes[-1] == 4 and [t.lists() for t in longer.trees[0][:12]] == [t.lists() for t in whole.trees[0]] and len(longer.trees[0]) == 16


def test_permutation_importance(spark, matrix):
    """Against a loop over days and features."""
    forest = boosting.boost(matrix, NAMES, "sales", [0.5], 30, 30, 8, 20).best()
    rows = matrix.where("is_val").withColumnRenamed("sales", "y")
    found = {r.feature: r.importance for r in boosting.permutation_importance(spark, forest, rows, blocks=2).collect()}
    order = F.xxhash64("id", F.lit("permute"))
    held = rows.select("id", "date", "y", "features", order.alias("key"), F.pmod(order, F.lit(2)).alias("block")).collect()
    groups = {}
    for r in held:
        groups.setdefault((r.date, r.block), []).append(r)
    more = dict.fromkeys(NAMES, 0.0)
    for group in groups.values():
        group.sort(key=lambda r: (r.key, r.id))
        for r, partner in zip(group, [*group[1:], group[0]]):
            own = r.features.toArray()
            for i, name in enumerate(NAMES):
                mixed = own.copy()
                mixed[i] = partner.features[i]
                plain, other = (abs(r.y - forest.margins(forest.codes(x[None]))[0, 0]) / 2 for x in (own, mixed))
                more[name] += (other - plain) / len(held)
    assert found == pytest.approx(more, abs=1e-9) and found["hour"] > found["price"] > found["noise"]


def test_responses_are_gradients():
    y, m = np.array([0.0, 1.0, 1.0]), np.array([0.3, -0.2, 2.0])
    for loss, labels in ((Loss(None), y), (Loss(0.9), y * 5)):
        g, _ = loss.response(labels, m)
        for i in range(3):
            up, down = (loss.error(labels, m + d * (np.arange(3) == i)) for d in (1e-6, -1e-6))
            assert g[i] == pytest.approx(-(up - down) / 2e-6, abs=1e-4)


def test_forest_text_and_edges():
    tree = Tree(np.array([0, -1, -1]), np.array([0, 0, 0]), np.array([1, 0, 0]), np.array([2, 0, 0]), np.array([0.0, 1.5, -2.0]))
    forest = Forest(["a"], boosting.quantile_edges(np.array([[1.0], [2.0], [2.0], [5.0]])), [0.5], [10.0], [[tree]], [[3.0, 1.0]])
    again = Forest.parse(forest.dump())
    assert again.edges == [[1.0, 2.0]] and again.codes(np.array([[1.0], [1.5], [9.0]])).ravel().tolist() == [0, 1, 2]
    assert again.margins(again.codes(np.array([[0.0], [7.0]]))).ravel().tolist() == [11.5, 8.0] and not math.isnan(again.errors[0][1])


def test_splits_of_a_turn_are_found_in_tasks(matrix, monkeypatch):
    """The driver searches no split itself, a task for each loss does; the trees repeat."""
    plain = boosting.boost(matrix, NAMES, "sales", [0.5, 0.9], 3, 3, 6, 5)
    here, search = [], boosting.split_sample

    def noted(*args):
        here.append(1)
        return search(*args)

    monkeypatch.setattr(boosting, "split_sample", noted)
    again = boosting.boost(matrix, NAMES, "sales", [0.5, 0.9], 3, 3, 6, 5)
    assert not here and [[t.lists() for t in k] for k in again.trees] == [[t.lists() for t in k] for k in plain.trees]
    assert [len(k) for k in plain.trees] == [3, 3]


def test_every_row_counts_for_bins_and_splits(matrix, monkeypatch):
    """Bins are those of all training rows, and trees are the same however few rows a task may hold."""
    train = np.stack([r.features.toArray() for r in matrix.where("NOT is_val").select("features").collect()])
    whole = boosting.boost(matrix, NAMES, "sales", [0.9], 2, 3, 4, 5)
    assert whole.edges == boosting.quantile_edges(train) and len(whole.edges[2]) == boosting.BINS - 1
    monkeypatch.setattr(boosting, "SAMPLE", 50)
    dealt = boosting.boost(matrix, NAMES, "sales", [0.9], 2, 3, 4, 5)
    assert dealt.dump() == whole.dump()


def test_rare_rows_are_split_off(spark):
    """25 of 100,000 rows, too few to be seen in a sample of a third, get a leaf of their own."""
    rows = spark.range(100_000).select(F.col("id").cast("string").alias("id"), F.lit("2020-01-01").cast("date").alias("date"),
                                       (F.col("id") % 4000 == 7).cast("double").alias("rare"), (F.col("id") % 10).cast("double").alias("other"))
    rows = rows.select("id", "date", F.array("rare", "other").alias("v"), (F.col("rare") * 1000 + F.col("other")).alias("sales"))
    forest = boosting.boost(rows.select("id", "date", "sales", array_to_vector("v").alias("features")), ["rare", "other"], "sales", [0.5], 30, 9, 12, 15)
    margins = forest.margins(forest.codes(np.array([[0.0, 4.0], [1.0, 7.0]])))[:, 0]
    assert margins[1] > margins[0] + 100


def brute_tree(codes, y, margin, q, leaves, leaf_rows):
    """Nested splits by trying every column and cut, best gain first: the rows of each leaf."""
    def split(rows):
        best = (0.0, None, None)
        for f in range(codes.shape[0]):
            for c in range(boosting.BINS):
                sides = rows[codes[f][rows] <= c], rows[codes[f][rows] > c]
                if min(map(len, sides)) >= leaf_rows:
                    g = [np.where(y[r] > margin[r], q, q - 1).sum() ** 2 / len(r) for r in (*sides, rows)]
                    if g[0] + g[1] - g[2] > best[0] + 1e-9:
                        best = (g[0] + g[1] - g[2], *sides)
        return best

    waiting = [(*split(np.arange(len(y))), np.arange(len(y)))]
    while len(waiting) < leaves:
        waiting.sort(key=lambda w: -w[0])
        if waiting[0][1] is None:
            break
        _, *sides, _ = waiting.pop(0)
        waiting += [(*split(r), r) for r in sides]
    return sorted(w[3].tolist() for w in waiting)


def test_tree_against_trying_every_split():
    r = np.random.default_rng(3)
    codes, margin = r.integers(0, [[8], [64], [3]], (3, 400)).astype(np.uint8), r.integers(0, 9, 400) / 4
    y = codes[0] * 2.0 + (codes[1] > 40) * 9 + r.integers(0, 12, 400)
    for q in (0.5, 0.9):
        tree, leaf = boosting.split_sample(codes.T, y, margin, Loss(q), np.ones(400, bool), np.arange(3), 9, 8, lambda part: part[None])
        assert sorted(np.flatnonzero(leaf == i).tolist() for i in np.unique(leaf)) == brute_tree(codes, y, margin, q, 9, 8)
        assert (tree.leaf(codes.T) == leaf).all()
        values = boosting.leaf_values(Loss(q), leaf, len(tree.feature), y, margin, lambda part: part[None])
        for i in np.unique(leaf):
            assert values[i] == pytest.approx(np.quantile(np.round((y - margin)[leaf == i] * boosting.GRID) / boosting.GRID, q))


def test_predictions_are_dealt_to_several_tasks(matrix):
    """A table in one file is not looked through by one task."""
    forest = Forest(NAMES, [[1.0]] * 3, [0.5], [2.0], [[]])
    found = forest.predict(matrix.coalesce(1), ["id"])
    assert found.select(F.spark_partition_id()).distinct().count() > 1 and found.where("margins[0] = 2").count() == 4000


def test_round_errors_do_not_depend_on_the_order_of_rows(spark):
    """Parts whose float sums differ with their order give one mean."""
    forest, codes = Forest(["a"], [[0.0]], [0.5], [0.0], [[]]), bytes([0])
    draw = random.Random(5)
    values = [draw.uniform(0, 1) * 10 ** (i % 7) for i in range(900)]
    means = set()
    for order in (values, values[::-1], sorted(values)):
        rows = spark.createDataFrame([(codes, v, 0.0, True) for v in order], "codes binary, y double, m0 double, is_val boolean")
        means.add(boosting.round_errors(rows, forest)[0][0])
    assert len(means) == 1 and means.pop() == pytest.approx(sum(values) / 1800)

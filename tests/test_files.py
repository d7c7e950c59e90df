import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.reshape import matching, melt_sales
from shelfcast.plans import jobs
from shelfcast.sources import raw_files, testbed
from shelfcast.sources.staging import shared_dir, stage
from shelfcast.sources.store import TableStore, table_counts


def write_inputs(folder):
    folder.mkdir()
    (folder / raw_files.SALES).write_text(
        "id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2,d_3\n"
        "a_CA,a,D,C,CA_1,CA,1,,3\nb_TX,b,D,C,TX_1,TX,0,5,0\n")
    (folder / raw_files.CALENDAR).write_text(
        "date,wm_yr_wk,weekday,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI\n"
        "2011-01-29,11101,Saturday,d_1,,,,,0,0,1\n2011-01-30,11101,Sunday,d_2,SuperBowl,Sporting,,,1,0,0\n")
    (folder / raw_files.PRICES).write_text("store_id,item_id,wm_yr_wk,sell_price\nCA_1,a,11101,2.5\n")


def test_absent_inputs_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match=r"sales_train_evaluation.csv, calendar.csv, sell_prices.csv"):
        raw_files.read_raw(spark, str(tmp_path))


def test_master_from_files(spark, tmp_path):
    write_inputs(tmp_path / "raw")
    rows = {(r["id"], r["d"]): r for r in jobs.master_from_files(spark, str(tmp_path / "raw")).collect()}
    assert set(rows) == {("a_CA", "d_1"), ("a_CA", "d_2"), ("b_TX", "d_1"), ("b_TX", "d_2")}  # d_3 is not in the calendar
    assert rows["a_CA", "d_2"]["sales"] == 0 and rows["a_CA", "d_2"]["event_type_1"] == "Sporting"
    assert rows["a_CA", "d_1"]["sell_price"] == 2.5 and rows["b_TX", "d_1"]["sell_price"] == 0.0
    assert rows["b_TX", "d_2"]["event_name_2"] == "" and rows["b_TX", "d_2"]["date"] == dt.date(2011, 1, 30)
    assert rows["a_CA", "d_1"]["snap_WI"] == 1 and rows["a_CA", "d_1"]["month"] == 1


def test_columns_are_found_by_name(spark, tmp_path):
    write_inputs(tmp_path / "raw")
    (tmp_path / "raw" / raw_files.PRICES).write_text("sell_price,wm_yr_wk,item_id,store_id\n2.5,11101,a,CA_1\n")
    rows = {(r["id"], r["d"]): r for r in jobs.master_from_files(spark, str(tmp_path / "raw")).collect()}
    assert rows["a_CA", "d_1"]["sell_price"] == 2.5


def test_a_cell_that_is_no_number_fails(spark, tmp_path):
    write_inputs(tmp_path / "raw")
    sales = tmp_path / "raw" / raw_files.SALES
    sales.write_text(sales.read_text().replace("a_CA,a,D,C,CA_1,CA,1,", "a_CA,a,D,C,CA_1,CA,one,"))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jobs.master_from_files(spark, str(tmp_path / "raw")).collect()


def test_a_write_that_stops_half_way_leaves_the_old_table(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", spark.range(3))
    reader = store.read("t")
    monkeypatch.setattr(store, "_point", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.replace("t", spark.range(7))
    assert store.read("t").count() == 3 and reader.count() == 3
    monkeypatch.undo()
    store.replace("t", spark.range(5), cluster_by=("id",))
    assert store.read("t").count() == 5 and reader.count() == 3  # the last version stays for those who read it


def test_build_tables_samples_features_not_classes(spark, tmp_path):
    write_inputs(tmp_path / "raw")
    store = TableStore(spark, str(tmp_path / "store"))
    jobs.build_tables(store, str(tmp_path / "raw"), sample=1)
    assert store.read("features").select("id").distinct().count() == 1
    assert store.read("demand_classes").count() == 2
    counts = {r["table_name"]: r["n_rows"] for r in table_counts({"master": store.read("master")}).collect()}
    assert counts == {"master": 4}


def test_melt(spark):
    wide = spark.createDataFrame([("x", 1, None, 3)], "id string, d_1 int, d_2 int, d_10 int")
    assert {(r["d"], r["sales"]) for r in melt_sales(wide, ["id"]).collect()} == {("d_1", 1), ("d_2", 0), ("d_10", 3)}


LONG = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, sales bigint"


def test_widen_keeps_series_with_gaps(spark):
    meta = ["i", "d", "c", "s", "CA"]
    rows = [("a", *meta, "d_1", 5), ("a", *meta, "d_10", 7), ("b", *meta, "d_2", None), ("b", *meta, "d_10", 3),
            ("c", *meta, None, 8), (None, *meta, "d_2", 9)]
    wide = raw_files.widen(spark.createDataFrame(rows, LONG))
    assert wide.columns[6:] == ["d_1", "d_2", "d_10"]
    assert {r["id"]: tuple(r)[6:] for r in wide.collect()} == {
        "a": (5, None, 7), "b": (None, None, 3), "c": (None, None, None), None: (None, 9, None)}
    assert raw_files.widen(spark.createDataFrame([], LONG)).collect() == []


def test_wide_rows_take_tasks_by_their_size(spark):
    """Each task over thousands of columns costs seconds, so they must not follow the partitions of the long rows."""
    meta = ["i", "d", "c", "s", "CA"]
    long = spark.createDataFrame([(f"x{i}", *meta, f"d_{j}", i + j) for i in range(40) for j in range(1, 6)], LONG)
    wide = raw_files.widen(long.repartition(64, "id"))
    assert wide.rdd.getNumPartitions() <= 4 and wide.count() == 40


def test_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert not store.exists("t")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    assert store.replace("t", df)
    assert not store.replace("t", df.filter(F.lit(False)))
    store.append("t", df.select("s", F.lit(2).alias("n")))
    assert {tuple(r) for r in store.read("t").collect()} == {(1, "a"), (2, "a")}
    # An append that died before the end left rows beside the table; they do not count, nor when it is tried again.
    df.select(F.lit(3).alias("n"), "s").write.parquet(store.parts("t")[0].rsplit("/", 1)[0] + "/v-died")
    store.append("t", df.select("s", F.lit(4).alias("n")))
    assert {tuple(r) for r in store.read("t").collect()} == {(1, "a"), (2, "a"), (4, "a")} and len(store.parts("t")) == 3
    # A table may be replaced from itself.
    store.replace("t", store.read("t").filter("n = 2"))
    assert [tuple(r) for r in store.read("t").collect()] == [(2, "a")]
    assert store.cached("t", lambda: df).first()["n"] == 2
    assert store.cached("t", lambda: df, force=True).first()["n"] == 1


def test_filters(spark):
    df = spark.createDataFrame([("CA", "x"), ("TX", "x")], "state_id string, cat_id string")
    assert df.filter(matching()).count() == 2
    assert df.filter(matching(state_id="CA", cat_id=None)).count() == 1


def test_fill_days(spark):
    d = [dt.date(2020, 1, i) for i in range(1, 8)]
    meta = ["i", "d", "c", "s", "CA"]
    rows = [("a", *meta, d[1], 5), ("a", *meta, d[4], 7), ("b", *meta, d[0], 1), ("b", *meta, d[6], 2)]
    sparse = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, sales bigint")
    got = {(r["id"], r["date"]): r["sales"] for r in testbed.fill_days(sparse).collect()}
    assert len(got) == 14
    assert {k: v for k, v in got.items() if v} == {("a", d[1]): 5, ("a", d[4]): 7, ("b", d[0]): 1, ("b", d[6]): 2}


def test_staged_table_has_a_short_lineage(spark):
    staged = stage(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count(), "t")
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
    assert shared_dir(spark)

from data import SF_MORE
from pyspark.sql import functions as F

from shelfcast.llm import langid


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_MORE}/documents.parquet").select("doc_id", "lang")
    got = langid.op2_language_id(spark, SF_MORE).join(truth, "doc_id")
    rows = got.collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == truth.count() and 0.25 < len(held) / len(rows) < 0.42
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_the_held_out_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF_MORE}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert langid.learn(docs.where(~langid.held_out())) == langid.learn(other.where(~langid.held_out()))


def test_narrow_margins_are_rejected(spark):
    contents = {"aa": b"the cat sat on the mat and the dog " * 40, "bb": b"der hund und die katze auf der matte " * 40}
    rows = {r.doc_id: r for r in langid.predict(spark.createDataFrame([(1, "the cat and the dog sat on the mat"), (2, "qqqq")], "doc_id long, text string"),
                                                contents, reject=0.05).collect()}
    assert rows[1].lang_pred == "aa" and not rows[1].rejected and rows[2].rejected and rows[2].lang_pred == "aa"


def test_odd_rows(spark, odd, none):
    contents = langid.learn(odd, docs=3, size=500)
    assert set(contents) == {"de", "en", "fr"} and all(0 < len(c) <= 500 for c in contents.values())
    rows = langid.predict(odd, contents).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r.lang_pred for r in rows if r.doc_id not in (None, 10)}
    assert [by[i] for i in (1, 2, 3, 9)] == ["und"] * 4 and by[6] == "de"
    assert langid.learn(none) == {} and {r.lang_pred for r in langid.predict(odd, {}).collect()} == {"und"}
    assert langid.predict(none, contents).collect() == []

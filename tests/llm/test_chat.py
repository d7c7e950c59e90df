from compare import compare, duck
from data import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import chat

MESSAGE = "conv_id long, turn long, role string, parts " + chat.PARTS


def test_query_is_its_sql(spark):
    assert compare(chat.op3_chat_format(spark, SF), duck(SF), chat.SQL["op3_chat_format"]) == []


def test_no_python_runs(spark):
    plan = chat.op3_chat_format(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_escape_round_trip(spark):
    seen = ["", "&", "&lt;", "<|end|>", "<<||>", "&amp;lt;s>", "[[INST][/INST]", "</s><s>", "&#91;INST]"]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(["&", "<", "|", "s", ">", "/", "[", "]", "INST", "lt;", "amp;", "#91;", "é"])).map("".join))
    def gather(text):
        seen.append(text)

    gather()
    rows = spark.createDataFrame([(t,) for t in seen], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in rows.select("t", "e", chat.unescape(F.col("e")).alias("back")).collect():
        assert r.back == r.t
        assert not any(mark in r.e for mark in chat.CONTROL)


def test_typed_parts(spark):
    parts = [("text", "see <|x|> ", None, None), ("image", None, "a.png", 2), ("text", "and", None, None), ("audio", None, "b.wav", 3), ("document", None, "c.pdf", None)]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("text", "ok", None, None)]), (1, 2, "user", None), (2, 0, None, [])], MESSAGE)
    rows = {r.conv_id: r for r in chat.format_chat(frame).collect()}
    r = rows[1]
    assert r.formatted == ("<|turn|>user<|body|>see &lt;|x|> " + "<|image|>" * 8 + "and" + "<|audio|>" * 6 + "<|document|>" * 8 + "<|end|>"
                           + "<|turn|>assistant<|body|>ok<|end|>" + "<|turn|>user<|body|><|end|>")
    assert [(a.place, a.kind, a.ref, a.tokens) for a in r.attachments] == [(0, "image", "a.png", 8), (0, "audio", "b.wav", 6), (0, "document", "c.pdf", 8)]
    assert r.extra_tokens == 22
    at, under = 0, ""
    for t in r.turns:
        under += r.formatted[at + t.start:at + t.start + t.length]
        at += t.chars
    assert under == "ok" and at == len(r.formatted)
    assert rows[2].formatted == "<|turn|><|body|><|end|>" and rows[2].extra_tokens == 0


def test_odd_rows(spark):
    part = [("text", "t" * 500_000, None, None)]
    frame = spark.createDataFrame([(None, 0, "user", part), (3, None, "assistant", part), (3, 1, "assistant", part), (3, 1, "assistant", part)], MESSAGE)
    read = {r.conv_id: r.read for r in chat.read_back(chat.format_chat(frame.withColumn("formatted", F.lit(1)))).collect()}
    assert [t.text for t in read[3]] == ["t" * 500_000] * 3 and len(read[None]) == 1 and read[None][0].loss == ""
    assert chat.format_chat(frame.limit(0)).collect() == []

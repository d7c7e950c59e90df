"""Chat formatting with typed content parts, in SQL expressions only.

A message holds an ordered array of parts ``struct<kind, text, ref, units>``.  The visitor turns each
part into text: ``text`` parts are escaped, ``image``, ``audio`` and ``document`` parts become a
placeholder, repeated once per token the model's encoder will put there (units x rate).  The same
walk records the attachments in order.

Template of a turn: ``<|turn|>role<|body|>content<|end|>``.  Inside roles and texts ``&`` becomes
``&amp;`` and the first character of every control string becomes ``&lt;`` or ``&#91;``; so no
control string survives in a text and :func:`unescape` gives the text back exactly.

Defined cases: null role or text is empty; null parts is no part; an unknown kind is a placeholder
``<|kind|>`` of its units at rate 1; turns that repeat a number are ordered by role and content;
rows whose conv_id is null form one conversation; a conversation is one output row by nature, so one
conversation must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Strings that steer a model or this template; all begin with "<" or "[".
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
FIRST = {"<": "&lt;", "[": "&#91;"}
#: Tokens per unit: an image unit is a tile, an audio unit a second, a document unit a page.
RATES = {"image": 4, "audio": 2, "document": 8}
PARTS = "array<struct<kind:string,text:string,ref:string,units:int>>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(FIRST[mark[0]] + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    for char, code in FIRST.items():
        text = F.replace(text, F.lit(code), F.lit(char))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def _tokens(part: Column) -> Column:
    rate = F.lit(1)
    for kind, r in RATES.items():
        rate = F.when(part["kind"] == kind, F.lit(r)).otherwise(rate)
    return F.coalesce(part["units"], F.lit(1)) * rate


def _is_text(part: Column) -> Column:
    return part["kind"].eqNullSafe(F.lit("text"))


def _content(parts: Column) -> Column:
    """The visitor: every part to its text, in order."""
    def visit(p: Column) -> Column:
        mark = F.concat(F.lit("<|"), escape(F.coalesce(p["kind"], F.lit("part"))), F.lit("|>"))
        return F.when(_is_text(p), escape(p["text"])).otherwise(F.repeat(mark, _tokens(p)))
    return F.array_join(F.transform(parts, visit), "")


def _attachments(parts: Column) -> Column:
    return F.transform(F.filter(parts, lambda p: ~_is_text(p)),
                       lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))


def format_chat(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted``, and for each turn in order ``turns``.

    ``turns`` has the turn's length in ``formatted`` and the part of it under the loss mask (``start`` from 0,
    ``length``; both count code points within the turn); ``attachments`` lists the non-text parts
    with their turn's place; ``extra_tokens`` is what the placeholders expand to.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY))
    # The parts of a turn are walked here, before rows are gathered.
    flat = messages.select("conv_id", "turn", "role", F.coalesce("parts", F.array().cast(PARTS)).alias("parts"))
    flat = flat.select("conv_id", "turn", "role", _content(F.col("parts")).alias("content"), _attachments(F.col("parts")).alias("attached"))
    flat = flat.select("conv_id", F.struct(
        "turn", "role", F.concat(head, content, F.lit(END)).alias("piece"),
        F.length(head).alias("start"), F.when(F.col("role") == loss_role, F.length("content")).otherwise(0).alias("length"),
        "attached").alias("t"))
    turns = flat.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return turns.select(
        "conv_id", F.array_join("t.piece", "").alias("formatted"),
        F.transform("t", lambda t: F.struct(F.length(t["piece"]).alias("chars"), t["start"].alias("start"),
                                            t["length"].alias("length"))).alias("turns"),
        F.flatten(F.transform("t", lambda t, i: F.transform(t["attached"], lambda a: F.struct(
            i.alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"),
    ).withColumn("extra_tokens", F.aggregate("attachments", F.lit(0), lambda s, a: s + a["tokens"]))


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and masked text out of formatted conversations, without the messages they came from."""
    # Every turn ends with END, so the last piece of the split is empty.
    pieces = F.slice(F.split("formatted", r"<\|end\|>"), F.lit(1), F.size("turns"))
    def one(piece: Column, turn: Column) -> Column:
        role = F.substring_index(F.substring(piece, len(TURN) + 1, turn["start"] - len(TURN)), BODY, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, turn["start"] + 1, turn["chars"])).alias("text"),
                        unescape(F.substring(piece, turn["start"] + 1, turn["length"])).alias("loss"))
    return chats.select("conv_id", "formatted", F.zip_with(pieces, F.col("turns"), one).alias("read"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations`` and conversation -1, digests read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                                                               F.lit(role).alias("role"), F.lit(probe).alias("text"))
                                                      for i, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))
    read = read_back(format_chat(rows.unionByName(extra).withColumn("parts", F.array(part))))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("read.loss", "")
    return read.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def _escaped(text: str) -> str:
    for old, new in (("&", "&amp;"), *((m, FIRST[m[0]] + m[1:]) for m in CONTROL)):
        text = f"replace({text}, '{old}', '{new}')"
    return text


SQL = {"op3_chat_format": f"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum({len(TURN + BODY + END)} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
    FROM said GROUP BY conv_id"""}

"""Chat formatting of conversations with typed content parts, as DataFrame expressions.

A message is a list of parts (text, image, audio, document).  A visitor flattens it into text in
which every attachment is an ordered placeholder, and records what each placeholder refers to and
how many tokens it expands to.  The template puts every turn between control strings; the
characters that control strings are made of are escaped inside texts, so none can occur there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control strings of the template (fixed values of this format).
TURN_OPEN, ROLE_CLOSE, TURN_CLOSE = "<s>[", "]\n", "</s>\n"
# Escapes, in the order in which they are applied; undone in the reverse order.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsqb;"), ("]", "&rsqb;")]
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 28  # pixels of an image patch, a token each
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 1024
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A message of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _expanded(part: Column) -> Column:
    """Tokens that an attachment expands to; an unknown extent counts as one token."""
    image = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    audio = F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND)
    document = part["pages"] * DOCUMENT_TOKENS_PER_PAGE
    return F.greatest(F.lit(1), F.coalesce(
        F.when(part["type"] == "image", image).when(part["type"] == "audio", audio)
        .when(part["type"] == "document", document), F.lit(1))).cast("long")


def format_conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, n_turns, loss_spans, attachments) of (conv_id, turn, role, parts).

    ``loss_spans`` lists, in order, the stretches to learn from: the bodies of the assistant's turns
    as (turn_index, turn_start, start, length) in code points of ``formatted``.  ``attachments`` lists
    (ordinal, turn, type, ref, tokens); ordinal k is the placeholder ``<type:k>``, counted from 0 through
    the conversation.

    Turns are ordered by turn, then role, then content, so ties and repeated rows have one defined
    order.  A null role or text is empty, null parts are no parts, a part of an unknown type is an
    attachment of that type, and a null conv_id is a conversation of its own.  Extra columns are
    left out.  A formatted conversation is one value, as its reader needs it.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "key")
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                           F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")).alias("parts"))
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"
    rows = rows.withColumn("key", F.to_json("parts")).withColumn("held", F.filter("parts", lambda p: ~is_text(p)))
    rows = rows.withColumn("first", F.coalesce(F.sum(F.size("held")).over(
        by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    rows = rows.withColumn("index", F.row_number().over(by_turn) - 1)
    before = lambda i: F.size(F.filter(F.slice(F.col("parts"), F.lit(1), i), lambda q: ~is_text(q)))
    body = F.array_join(F.transform("parts", lambda p, i: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit(""))))
                                    .otherwise(F.concat(F.lit("<"), escape(p["type"]), F.lit(":"),
                                                        (F.col("first") + before(i)).cast("string"), F.lit(">")))), "")
    rows = rows.withColumn("body", body).withColumn(
        "opening", F.concat(F.lit(TURN_OPEN), escape(F.col("role")), F.lit(ROLE_CLOSE)))
    rows = rows.withColumn("piece", F.concat("opening", "body", F.lit(TURN_CLOSE)))
    rows = rows.withColumn("turn_start", F.coalesce(F.sum(F.length("piece").cast("long")).over(
        by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("refs", F.transform("held", lambda p, i: F.struct(
        (F.col("first") + i).alias("ordinal"), F.col("turn").alias("turn"), p["type"].alias("type"), p["ref"].alias("ref"),
        _expanded(p).alias("tokens"))))
    span = F.when(F.col("role") == LEARNED_ROLE, F.struct(
        F.col("index").cast("int").alias("turn_index"), F.col("turn_start"),
        (F.col("turn_start") + F.length("opening")).alias("start"), F.length("body").cast("long").alias("length")))
    turns = F.sort_array(F.collect_list(F.struct("index", "piece", span.alias("span"), "refs")))
    out = rows.groupBy("conv_id").agg(turns.alias("turns"))
    return out.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["refs"])).alias("attachments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text): turns (role, text) and the learned text, read from the output alone.

    Placeholders stay in the texts as they are written.
    """
    pieces = F.filter(F.split("formatted", TURN_CLOSE), lambda x: x != "")
    rows = formatted.withColumn("pieces", pieces)

    def turn(piece):
        rest = F.substring_index(piece, TURN_OPEN, -1)
        role = F.substring_index(rest, ROLE_CLOSE, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(
            rest, F.length(role) + F.lit(len(ROLE_CLOSE) + 1))).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.element_at(F.col("pieces"), s["turn_index"] + 1), (s["start"] - s["turn_start"] + 1).cast("int"),
        s["length"].cast("int"))))
    return rows.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"),
                       F.array_join(loss, "").alias("loss_text"))


#: A conversation whose texts hold control strings of common templates (its id is fixed by the query's contract).
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Formats all conversations and the probe, reads them back and returns digests of what was read."""
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))
    made = format_conversations(rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    read = read_back(made)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))

"""Chat formatting of typed content parts, with DataFrame functions only.

A turn is written ``<s>role[/ROLE]body</s>``.  Control strings start with
``<`` or ``[``; inside roles and texts each of these two and each backslash is
followed by an added backslash, so no text can hold a control string and
unescaping restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
TURN, ROLE_END, TURN_END = "<s>", "[/ROLE]", "</s>"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
OTHER_PLACEHOLDER = "<attachment>"

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\<\[])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\<\[])\\", "$1")


def text_part(text: Column) -> Column:
    """A list of one text part; null is an empty text."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))).cast(PARTS)


def expanded_tokens(part: Column, patch: int, audio_rate: float, page_tokens: int) -> Column:
    """Tokens that a placeholder stands for, at least 1; unknown sizes count as 1."""
    count = (F.when(part.type == "image", F.ceil(part.width / patch) * F.ceil(part.height / patch))
             .when(part.type == "audio", F.ceil(part.seconds * audio_rate))
             .when(part.type == "document", part.pages * page_tokens)).cast("long")
    return F.when(part.type == "text", F.lit(0)).otherwise(F.greatest(F.coalesce(count, F.lit(1)), F.lit(1))).cast("long")


def visit(part: Column) -> Column:
    """The text a part becomes: its escaped text, or the placeholder of its type.

    A null part or a part of null type is an empty text; a type that is not
    known gets the placeholder of other attachments."""
    shown = F.coalesce(*[F.when(part.type == t, F.lit(s)) for t, s in PLACEHOLDERS.items()], F.lit(OTHER_PLACEHOLDER))
    return F.when(part.type.isNull(), "").when(part.type == "text", F.coalesce(escape(part.text), F.lit(""))).otherwise(shown)


def format_conversations(messages: DataFrame, parts: str | None = None, loss_role: str = "assistant", patch: int = 14,
                         audio_rate: float = 25.0, page_tokens: int = 512) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_mask, attachments, expanded_tokens``.

    ``messages`` has ``conv_id, turn, role`` and either ``text`` or a column
    ``parts`` (of type :data:`PARTS`) named by the argument; other columns are
    ignored.  Turns are in order of ``turn``, then role, then body, nulls first,
    so repeated rows and ties give one result.  A null role or text is empty;
    rows with null ``conv_id`` form one conversation.  ``loss_mask`` lists
    ``(turn_index, start, length)``, in code points from the turn's first;
    ``attachments`` lists the placeholders in order with their references and
    ``expanded_tokens`` counts, the last column their sum.

    A conversation is one value of the result, so its turns meet in one group;
    lists are gathered map-side before the shuffle.
    """
    content = F.coalesce(F.col(parts), F.array().cast(PARTS)) if parts else text_part(F.col("text"))
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), content.alias("parts"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(ROLE_END))
    body = F.array_join(F.transform("parts", visit), "", "")
    media = F.filter("parts", lambda p: p.type.isNotNull() & (p.type != "text"))
    refs = F.transform(media, lambda p: F.struct(p.type.alias("type"), p.ref.alias("ref"), expanded_tokens(p, patch, audio_rate, page_tokens).alias("expanded_tokens")))
    rows = rows.select("conv_id", F.struct("turn", "role", body.alias("body"), head.alias("head"), refs.alias("refs")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    mask = F.filter(F.transform("t", lambda t, i: F.struct(i.cast("int").alias("turn_index"), F.char_length(t["head"]).alias("start"),
                                                           F.when(t.role == loss_role, F.char_length(t.body)).alias("length"))), lambda m: m.length.isNotNull())
    listed = F.flatten(F.transform("t", lambda t, i: F.transform(t.refs, lambda a: F.struct(i.cast("int").alias("turn_index"), a.type.alias("type"), a.ref.alias("ref"), a.expanded_tokens.alias("expanded_tokens")))))
    done = turns.select("conv_id", F.array_join(F.transform("t", lambda t: F.concat(t["head"], t.body, F.lit(TURN_END))), "").alias("formatted"),
                        mask.alias("loss_mask"), listed.alias("attachments"))
    return done.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x.expanded_tokens))


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, body>>`` out of a formatted conversation; the body stays escaped."""
    pieces = F.split(formatted, TURN_END, -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(turns, lambda t: F.struct(unescape(F.substring_index(F.substring(t, len(TURN) + 1, 2**31 - 1), ROLE_END, 1)).alias("role"),
                                                 F.substring_index(t, ROLE_END, -1).alias("body"), t.alias("turn")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations hold, from ``formatted`` and ``loss_mask`` alone."""
    rows = formatted.withColumn("turns", read_turns(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), unescape(t.body), F.lit("\n"))), "")
    under = F.array_join(F.transform("loss_mask", lambda m: unescape(F.get(F.col("turns"), m.turn_index).turn.substr(m.start + 1, m.length))), "")
    return (rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), under.alias("under"), F.char_length("formatted").cast("long").alias("formatted_chars"))
            .select("conv_id", "n_turns", F.sha2(F.encode("said", "UTF-8"), 256).alias("turns_sha256"), F.char_length("under").cast("long").alias("loss_chars"),
                    F.sha2(F.encode("under", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars"))

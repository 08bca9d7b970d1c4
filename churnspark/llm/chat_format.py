"""Chat formatting with typed content parts (operator 5).

A message is a role and an array of parts, each a struct of kind, text, ref and units. A visitor
(one expression over the parts) turns them into one string: text is escaped, every image, audio or
document part becomes a placeholder ``<kind n>`` numbered within the conversation, its reference
and its number of tokens (units times the rate of its kind) are recorded in order.

Template: ``<turn ROLE>`` text ``</turn>`` per message. In texts and roles a backslash becomes
``\\s``, ``<`` becomes ``\\l`` and ``>`` becomes ``\\g``, so a bracket in the output always belongs to
the template, and replacing the three back in reverse order restores any text. The loss mask is
recorded as code point spans of the assistant's contents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.text_columns import word_count

PART = "struct<kind:string,text:string,ref:string,units:int>"
# Tokens that stand for one unit of a part: an image tile, a second of audio, a page.
TOKEN_RATES = {"image": 256, "audio": 25, "document": 512}
_OPEN, _CLOSE = "<turn ", "</turn>"
_ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """A message's text as its only part."""
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(1).alias("units"),
    )
    return F.array(part).cast(f"array<{PART}>")


def _attachments(parts: Column) -> Column:
    return F.filter(parts, lambda p: p["kind"].isin(*TOKEN_RATES))


def _visit(parts: Column, before: Column) -> Column:
    """The parts as one string; ``before``: attachments of earlier messages."""

    def shown(part: Column, place: Column) -> Column:
        number = before + F.size(_attachments(F.slice(parts, F.lit(1), place + 1)))
        mark = F.concat(F.lit("<"), part["kind"], F.lit(" "), number.cast("string"), F.lit(">"))
        return F.when(part["kind"].isin(*TOKEN_RATES), mark).otherwise(escaped(F.coalesce(part["text"], F.lit(""))))

    return F.array_join(F.transform(parts, shown), "")


def _tokens(part: Column) -> Column:
    rate = F.lit(0)
    for kind, tokens in TOKEN_RATES.items():
        rate = F.when(part["kind"] == kind, tokens).otherwise(rate)
    return (rate * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))).cast("long")


def format_chats(
    messages: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, formatted, loss_spans, attachments, n_tokens.

    ``loss_spans``: array of (start, length) in code points from 0, one per message of
    ``loss_role``, empty ones included. ``attachments``: array of (number, kind, ref, tokens).
    ``n_tokens``: words of the texts plus the tokens that stand for attachments.

    Messages are ordered by turn, equal turns by role and content; repeated rows stay. Null parts,
    texts, roles and turns count as empty, a part of an unknown kind as its text. A null id is a
    conversation of its own. An empty table gives an empty result; other columns are not read.
    """
    parts = F.coalesce(F.col(parts_col).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = messages.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.filter(parts, lambda p: p.isNotNull()).alias("parts"),
    )
    order = Window.partitionBy("id").orderBy("turn", "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(order))
    held = F.coalesce(F.sum(F.size(_attachments(F.col("parts")))).over(earlier), F.lit(0))
    rows = rows.withColumn("before", held)
    rows = rows.withColumn("head", F.concat(F.lit(_OPEN), escaped(F.col("role")), F.lit(">")))
    rows = rows.withColumn("content", _visit(F.col("parts"), F.col("before")))
    rows = rows.withColumn("length", F.char_length("head") + F.char_length("content") + len(_CLOSE))
    rows = rows.withColumn("start", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    span = F.struct(
        (F.col("start") + F.char_length("head")).alias("start"),
        F.char_length("content").cast("long").alias("length"),
    )
    words = F.aggregate(
        "parts", F.lit(0).cast("long"), lambda n, p: n + F.when(p["kind"].isin(*TOKEN_RATES), 0).otherwise(word_count(p["text"]))
    )
    expanded = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + _tokens(p))
    listed = F.transform(
        _attachments(F.col("parts")),
        lambda p, i: F.struct(
            (F.col("before") + i + 1).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"),
            _tokens(p).alias("tokens"),
        ),
    )
    message = F.struct(
        "place",
        F.concat("head", "content", F.lit(_CLOSE)).alias("piece"),
        F.when(F.col("role") == loss_role, span).alias("span"),
        listed.alias("listed"),
    )
    grouped = rows.groupBy("id").agg(
        F.array_sort(F.collect_list(message)).alias("m"), F.sum(words + expanded).alias("n_tokens")
    )
    return grouped.select(
        F.col("id").alias(id_col),
        F.array_join(F.col("m.piece"), "").alias("formatted"),
        F.filter(F.col("m.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten("m.listed").alias("attachments"),
        "n_tokens",
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation; placeholders stay in the text."""
    pieces = F.filter(F.split(formatted, _CLOSE), lambda x: x != "")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ">", 1)
        body = F.substr(piece, F.char_length(head) + 2)
        return F.struct(
            unescaped(F.substr(head, F.lit(len(_OPEN) + 1))).alias("role"), unescaped(body).alias("text")
        )

    return F.transform(pieces, turn)


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescaped(
        F.array_join(
            F.transform(spans, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))), ""
        )
    )

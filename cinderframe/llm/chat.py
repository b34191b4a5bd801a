r"""Chat formatting with a grammar round trip.

    conversation := turn*
    turn         := "<s>[INST] " role " [/INST]\n" body "</s>\n"

``role`` is percent-encoded; ``body`` holds no control string (``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) as such.  Within a body, a backslash after the first character of a control string
(``<\/s>``) is one level of escaping; reading takes one level off, so texts that look escaped
themselves gain a level and come back unchanged.

A conversation is first rendered as it is and parsed again.  Turns that don't come back equal
to the source are rendered anew with their control strings escaped, and the result is parsed and
compared once more.  Everything is DataFrame functions on one row per conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<s>[INST] ", " [/INST]\n", "</s>\n"
_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])(\\*)\\(/?s>|/?INST\])"
_BARE = r"<s>|</s>|\[INST\]|\[/INST\]"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _render(turns: Column) -> Column:
    """One string from (role, body) turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), F.url_encode(t["role"]), F.lit(MIDDLE), t["body"], F.lit(END))), "")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation.

    A piece that the grammar doesn't allow comes back as a turn without role and text, which
    equals no source turn."""
    pieces = F.filter(F.split(formatted, END, -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        at = F.locate(MIDDLE, piece)
        role = F.substr(piece, F.lit(len(START) + 1), at - len(START) - 1)
        body = F.substr(piece, at + len(MIDDLE))
        allowed = F.startswith(piece, F.lit(START)) & (at > 0) & ~F.rlike(body, F.lit(_BARE))
        return F.struct(F.when(allowed, F.try_url_decode(role)).alias("role"),
                        F.when(allowed, unescape(body)).alias("text"))

    return F.transform(pieces, turn)


def _came_back(source: Column, parsed: Column) -> Column:
    return F.coalesce(source == parsed, F.lit(False))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: conv_id, formatted,
    turns (role, text: parsed from formatted), loss_spans, escaped_turns.

    Turns are in order of ``turn`` (nulls first; ties by role, then text; repeated rows are
    turns of their own).  A null role or text is empty; a null conv_id is one conversation.
    Other columns are ignored, an empty table gives no rows.  ``loss_spans`` are the ranges
    (start, length in characters) of formatted that hold assistant bodies, as escaped."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("rows"))
               .select("conv_id", F.transform("rows", lambda t: F.struct(
                   t["role"].alias("role"), t["text"].alias("text"))).alias("source")))
    plain = grouped.withColumn("plain", _render(F.transform("source", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("body")))))
    first = plain.withColumn("equal", _came_back(F.col("source"), parse(F.col("plain"))))

    # A turn conflicts if, rendered alone, it doesn't come back.
    def rendered(t: Column) -> Column:
        conflict = F.rlike(t["text"], F.lit(_BARE)) | (unescape(t["text"]) != t["text"])
        return F.struct(t["role"].alias("role"),
                        F.when(conflict, escape(t["text"])).otherwise(t["text"]).alias("body"),
                        conflict.alias("escaped"))

    bodies = F.when(F.col("equal"), F.transform("source", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("body"), F.lit(False).alias("escaped")))
                    ).otherwise(F.transform("source", rendered))
    second = (first.withColumn("bodies", bodies)
              .withColumn("formatted", F.when(F.col("equal"), F.col("plain"))
                          .otherwise(_render(F.col("bodies"))))
              .withColumn("turns", parse(F.col("formatted"))))
    checked = second.withColumn("formatted", F.when(
        _came_back(F.col("source"), F.col("turns")), F.col("formatted")).otherwise(
            F.raise_error(F.concat(F.lit("conversation doesn't come back: "),
                                   F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))))
    zero = F.struct(F.lit(0).alias("at"),
                    F.array().cast("array<struct<start: int, length: int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        body_at = acc["at"] + len(START) + F.length(F.url_encode(t["role"])) + len(MIDDLE)
        size = F.length(t["body"])
        span = F.array(F.struct(body_at.alias("start"), size.alias("length")))
        return F.struct((body_at + size + len(END)).alias("at"),
                        F.when(t["role"] == LOSS_ROLE, F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    return checked.select(
        "conv_id", "formatted", "turns",
        F.aggregate("bodies", zero, step, lambda a: a["spans"]).alias("loss_spans"),
        F.size(F.filter("bodies", lambda t: t["escaped"])).alias("escaped_turns"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what was read back: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, escaped_turns.  The loss text is cut out of the formatted
    string by the loss spans and unescaped."""
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substr("formatted", s["start"] + 1, s["length"]))), "")
    return formatted.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("escaped_turns").cast("long").alias("escaped_turns"))

"""Chat formatting of typed content parts, with DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. A visitor turns each part
into its piece of the output by its type: text is escaped, everything else becomes a placeholder
with a number, counted through the conversation, and an attachment record (number, type,
reference, expanded tokens). The pieces keep their order.

The template of a conversation is, for each turn, ``<turn:ROLE>`` content ``<end>``, and the
placeholder of part k is ``<image:k>`` (audio, document). The marks are made of ``<``, ``>``;
in texts and roles ``&``, ``<`` and ``>`` are written ``&a``, ``&l`` and ``&g``, so no text can
hold a mark and unescaping gives back exactly what was there. The loss mask covers the contents of
assistant turns, as (start, end) characters of the formatted text.

Turns are joined in two steps: first those of a conversation with nearby turn numbers, then these
chunks, so that a conversation with very many rows is joined by many tasks before it meets as one
row, which its one formatted text needs.

Defined cases: a null text is empty, a null role is written as an empty one, an unknown part type
counts as a document; turns with equal numbers are ordered by role, then text; null turn numbers
come first; rows repeated as a whole are turns of their own; rows with a null conv_id are one
conversation; a conversation without assistant turns has an empty mask; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers that are joined in a first step.
CHUNK = 64
#: Expanded tokens: of a 28 x 28 tile of an image, a second of audio, a page of a document.
TILE, AUDIO_PER_SECOND, PER_PAGE = 28, 25, 256

PARTS = "array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"


def escaped(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for sign, code in (("&", "&a"), ("<", "&l"), (">", "&g")):
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for sign, code in ((">", "&g"), ("<", "&l"), ("&", "&a")):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def text_part(text: Column) -> Column:
    """A turn that is only text, as parts."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *nothing)).cast(PARTS)


def _kind(part: Column) -> Column:
    return F.when(part["type"].isin("text", "image", "audio"), part["type"]).otherwise(F.lit("document"))


def expanded_tokens(part: Column) -> Column:
    """Tokens that stand for an attachment once it is read."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(TILE)) / TILE) * F.ceil(F.coalesce(part["height"], F.lit(TILE)) / TILE)
    return (
        F.when(_kind(part) == "text", F.lit(0))
        .when(_kind(part) == "image", tiles)
        .when(_kind(part) == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_PER_SECOND))
        .otherwise(F.coalesce(part["pages"], F.lit(1)) * PER_PAGE)
        .cast("long")
    )


def visited(parts: Column) -> Column:
    """Each part as (piece, kind, ref, tokens): the piece is escaped text, or null for an attachment."""
    return F.transform(
        F.coalesce(parts, F.array().cast(PARTS)),
        lambda p: F.struct(
            F.when(_kind(p) == "text", escaped(p["text"])).alias("piece"),
            _kind(p).alias("kind"),
            p["ref"].alias("ref"),
            expanded_tokens(p).alias("tokens"),
        ),
    )


def formatted(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, parts) to one row for each conversation.

    conv_id, formatted, loss_mask (array of start, end), attachments (array of number, kind, ref,
    tokens, turn), attachment_tokens.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        escaped(F.col("role")).alias("role"),
        visited(F.col("parts")).alias("pieces"),
    )
    turn = F.struct("turn", "role", "pieces")
    chunk = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / CHUNK)
    # equal turn numbers may be many, so rows of one chunk are spread before they are joined
    spread = F.pmod(F.xxhash64("turn", "role", "pieces"), F.lit(16))
    rows = rows.groupBy("conv_id", chunk.alias("chunk"), spread.alias("spread")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.flatten(F.collect_list("turns"))).alias("turns"))

    # attachments get their number from those of earlier turns
    attached = F.transform("turns", lambda t: F.size(F.filter(t["pieces"], lambda p: p["kind"] != "text")))
    whole = whole.withColumn("attached", attached).withColumn("some", F.exists("attached", lambda n: n > 0))
    before = F.transform("attached", lambda n, i: F.aggregate(F.slice("attached", F.lit(1), i), F.lit(0), lambda a, b: a + b))
    whole = whole.withColumn("before", F.when(F.col("some"), before).otherwise(F.transform("attached", lambda n: F.lit(0))))

    def numbered(pieces: Column, first: Column) -> Column:
        """The pieces of a turn, attachments with their numbers."""
        start = F.struct(first.cast("long").alias("n"), F.array().cast("array<struct<number: bigint, piece: string, kind: string, ref: string, tokens: bigint>>").alias("out"))

        def add(state: Column, p: Column) -> Column:
            other = p["kind"] != "text"
            number = F.when(other, state["n"] + 1)
            mark = F.concat(F.lit("<"), p["kind"], F.lit(":"), number.cast("string"), F.lit(">"))
            one = F.struct(
                number.alias("number"), F.when(other, mark).otherwise(p["piece"]).alias("piece"),
                p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"),
            )
            return F.struct(F.coalesce(number, state["n"]).alias("n"), F.concat(state["out"], F.array(one)).alias("out"))

        return F.aggregate(pieces, start, add, lambda s: s["out"])

    plain = F.transform("turns", lambda t: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"),
        F.transform(t["pieces"], lambda p: F.struct(
            F.lit(None).cast("long").alias("number"), p["piece"].alias("piece"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"),
        )).alias("pieces"),
    ))
    mixed = F.transform(
        F.arrays_zip(F.col("turns").alias("t"), F.col("before").alias("b")),
        lambda z: F.struct(z["t"]["turn"].alias("turn"), z["t"]["role"].alias("role"), numbered(z["t"]["pieces"], z["b"]).alias("pieces")),
    )
    whole = whole.withColumn("turns", F.when(F.col("some"), mixed).otherwise(plain))

    head = lambda t: F.concat(F.lit("<turn:"), t["role"], F.lit(">"))
    body = lambda t: F.array_join(t["pieces"]["piece"], "")
    tail = "<end>"
    text = F.array_join(F.transform("turns", lambda t: F.concat(head(t), body(t), F.lit(tail))), "")
    sizes = F.transform("turns", lambda t: F.struct(
        F.char_length(head(t)).cast("long").alias("head"), F.char_length(body(t)).cast("long").alias("body"), (t["role"] == "assistant").alias("own"),
    ))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("mask"))

    def step(s: Column, t: Column) -> Column:
        start = s["at"] + t["head"]
        span = F.struct(start.alias("start"), (start + t["body"]).alias("end"))
        return F.struct(
            (start + t["body"] + len(tail)).alias("at"), F.when(t["own"], F.concat(s["mask"], F.array(span))).otherwise(s["mask"]).alias("mask")
        )

    records = F.flatten(F.transform("turns", lambda t: F.transform(
        F.filter(t["pieces"], lambda p: p["kind"] != "text"),
        lambda p: F.struct(p["number"].alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"), t["turn"].alias("turn")),
    )))
    out = whole.select(
        "conv_id", text.alias("formatted"), F.aggregate(sizes, state, step, lambda s: s["mask"]).alias("loss_mask"), records.alias("attachments")
    )
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, b: a + b["tokens"]))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped; placeholders stay."""
    turns = F.filter(F.split(formatted, "<turn:"), lambda t: t != "")
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped(F.substring_index(t, ">", 1)).alias("role"),
            # what lies between the head's mark and the end mark; a placeholder has both signs
            unescaped(F.regexp_replace(F.regexp_replace(t, "^[^>]*>", ""), "<end>$", "")).alias("text"),
        ),
    )


def under_mask(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(mask, lambda m: unescaped(F.substring(formatted, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), ""
    )

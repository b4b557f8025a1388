"""Chat formatting with DataFrame functions only: typed content parts, a template and its loss mask.

A turn's content is a list of typed parts. A visitor flattens them in order: text is escaped, an image, sound or document
becomes a placeholder, and its reference and the tokens it will expand to are recorded. A conversation is one string of
marked turns. Control strings inside texts, those of this template and of two common others, get a backslash after their
first character; where backslashes stood there already they get one more, so taking one away restores any text.

A conversation is one row of the result, so its turns meet in one task; nothing else does.

Defined results: rows of a conversation are ordered by turn, equal turns by role and content; null turns come first. A
null role or text counts as empty, a part of unknown kind as text. A null conv_id is a conversation like any other.
Repeated rows are repeated turns. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.columns import block_sums, sum_before

START, SEPARATOR, END = "<|start|>", "<|content|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens: of an image for each square of so many pixels, of sound for a second, of a document for a page; and of an
#: attachment whose size is not known.
PATCH, PER_SECOND, PER_PAGE, UNKNOWN_SIZE = 28, 12.5, 1024, 256

_CONTROL = r"(/?s>|\||/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_CONTROL}", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){_CONTROL}", "$1$2$3")


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*PLACEHOLDERS), F.lit(False))


def visit(part: Column) -> Column:
    """What a part is in the string."""
    out = F.coalesce(escape(part["text"]), F.lit(""))
    for kind, placeholder in PLACEHOLDERS.items():
        out = F.when(part["kind"].eqNullSafe(kind), F.lit(placeholder)).otherwise(out)
    return out


def expanded(part: Column) -> Column:
    """The tokens that an attachment's placeholder stands for."""
    size = (
        F.when(part["kind"] == "image", F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH))
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * PER_SECOND))
        .otherwise((part["pages"] * PER_PAGE).cast("long"))
    )
    return F.coalesce(size, F.lit(UNKNOWN_SIZE)).cast("long")


def text_part(text: Column) -> Column:
    nothing = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[nothing.alias(n) for n in ("uri", "width", "height", "seconds", "pages")]).cast(PART))


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length in code points), attachments (kind, uri, tokens, turn's place), expanded_tokens.

    ``rows``: conv_id, turn, role, and ``parts`` (an array of PART) or ``text``.
    """
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in rows.columns else text_part(F.col("text"))
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(parts, F.array().cast(f"array<{PART}>")).alias("parts"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    flat = turns.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("loss"),
                F.concat(F.lit(START), escape(t["role"]), F.lit(SEPARATOR)).alias("head"),
                F.array_join(F.transform(t["parts"], visit), "").alias("content"),
            ),
        ).alias("blocks"),
        F.flatten(
            F.transform(
                "turns",
                lambda t, i: F.transform(
                    F.filter(t["parts"], _is_attachment), lambda p: F.struct(p["kind"].alias("kind"), p["uri"].alias("uri"), expanded(p).alias("tokens"), i.alias("place"))
                ),
            )
        ).alias("attachments"),
    )
    sized = flat.withColumn("lengths", F.transform("blocks", lambda b: (F.length(b["head"]) + F.length(b["content"]) + len(END)).cast("long"))).withColumn("sums", block_sums(F.col("lengths")))
    spans = F.filter(
        F.transform(
            "blocks",
            lambda b, i: F.struct(b["loss"].alias("loss"), (sum_before(F.col("lengths"), F.col("sums"), i) + F.length(b["head"])).cast("int").alias("start"), F.length(b["content"]).alias("length")),
        ),
        lambda s: s["loss"],
    )
    return sized.select(
        "conv_id",
        F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], b["content"], F.lit(END))), "").alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_spans"),
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string, unescaped."""
    pieces = F.slice(F.split(formatted, r"<\|start\|>"), 2, 1 << 30)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(p, SEPARATOR, 1)).alias("role"),
            unescape(F.regexp_extract(p, r"(?s)^.*?<\|content\|>(.*)<\|end\|>$", 1)).alias("text"),
        ),
    )


def digest(rows: DataFrame) -> DataFrame:
    """One row per conversation, worked out from the formatted string and its mask alone."""
    masked = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    read = format_chats(rows).select("conv_id", "expanded_tokens", F.length("formatted").cast("long").alias("formatted_chars"), read_back(F.col("formatted")).alias("turns"), masked.alias("masked"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked"), 256).alias("loss_sha256"),
        "formatted_chars",
        "expanded_tokens",
    )

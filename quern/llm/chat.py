"""Chat formatting with typed content parts.

A visitor flattens the parts of every turn in order: text is escaped, and an image, a sound or a document becomes a
placeholder. The k-th placeholder of a conversation stands for its k-th attachment, which is recorded with its source and
the number of tokens it expands to. Turns are marked by control strings that no escaped text can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
START, END, NEW_LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
UNKNOWN = "<|unknown|>"

PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"

#: Pixels of an image patch's side, patches to a token, and tokens a second of sound and a page stand for.
PATCH, PATCHES_PER_TOKEN, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 14, 4, 25, 1024


def escape(text: Column) -> Column:
    """Put a backslash into every `<|`, and one more into every `<\\…|`, so that `<|` no longer occurs."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_part(text: Column) -> Column:
    """A content part of type text."""
    return F.struct(
        F.lit("text").alias("type"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("uri"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )


def visit_text(part: Column) -> Column:
    """What a part other than text becomes in the formatted text. A part of null or unknown type keeps its place."""
    out = F.when(part["type"] == "image", F.lit(PLACEHOLDERS["image"]))
    for kind in ("audio", "document"):
        out = out.when(part["type"] == kind, F.lit(PLACEHOLDERS[kind]))
    return out.otherwise(F.lit(UNKNOWN))


def is_text(part: Column) -> Column:
    return part["type"].eqNullSafe("text")


def flatten_parts(parts: Column) -> Column:
    """The parts of a turn as one string. Neighbouring text parts are joined first and escaped as one text, so no control
    string can come about where two of them meet."""
    numbers = F.transform(parts, lambda part, i: F.when(is_text(part), F.lit(None)).otherwise(i + 1).cast("int"))
    size = F.size(parts)
    cuts = F.concat(F.array(F.lit(0)), F.array_compact(numbers), F.array(size + 1))

    def piece(start: Column, i: Column) -> Column:
        end = F.try_element_at(cuts, (i + 2).cast("int"))
        texts = F.transform(F.slice(parts, start + 1, end - start - 1), lambda part: F.coalesce(part["text"], F.lit("")))
        mark = F.when(end <= size, visit_text(F.get(parts, end - 1))).otherwise(F.lit(""))
        return F.concat(escape(F.array_join(texts, "")), mark)

    return F.array_join(F.transform(F.slice(cuts, F.lit(1), F.size(cuts) - 1), piece), "")


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to: at least one; missing measures count as the smallest."""
    def patches(side: str) -> Column:
        return F.greatest(F.ceil(F.coalesce(part[side], F.lit(1)) / PATCH), F.lit(1))

    image = F.ceil(patches("width") * patches("height") / PATCHES_PER_TOKEN)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND)
    pages = F.coalesce(part["pages"], F.lit(1)) * TOKENS_PER_PAGE
    found = F.when(part["type"] == "image", image).when(part["type"] == "audio", audio)
    return F.greatest(found.when(part["type"] == "document", pages).otherwise(1), F.lit(1)).cast("bigint")


def visit_attachment(part: Column) -> Column:
    return F.struct(part["type"].alias("type"), part["uri"].alias("uri"), expanded_tokens(part).alias("tokens"))


def format_conversations(
    turns: DataFrame, parts: Column, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    loss_roles: Sequence[str] = ("assistant",),
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans, attachments, attachment_tokens.

    Rows go by turn, then role and text; a null turn comes first. A null role or text is empty, a null list of parts has
    no parts; rows that repeat are turns of their own; rows without a conversation id make one conversation with a null
    id; an empty table gives no rows. loss_spans are (turn, start, end) in code points of `formatted`, turn being the
    number of the row from 0: the contents of turns whose role is in `loss_roles`, without the marks around them.
    Other columns are not read. A conversation is one text, so one task writes it.
    """
    part_list = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        flatten_parts(part_list).alias("body"),
        F.transform(F.filter(part_list, lambda p: ~is_text(p)), visit_attachment).alias("files"),
    ).withColumn("head", F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEW_LINE)), F.lit("\n")))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", unescape(F.col("body")), "body")
    before = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.length("head") + F.length("body") + len(END)
    placed = rows.select(
        "conv_id", "role", "head", "body", "files",
        (F.row_number().over(by_turn) - 1).alias("at"),
        (F.coalesce(F.sum(whole).over(before), F.lit(0)) + F.length("head")).alias("start"),
    )
    made = placed.select(
        "conv_id",
        F.struct(
            "at",
            F.concat("head", "body", F.lit(END)).alias("text"),
            F.col("role").isin(*loss_roles).alias("loss"),
            "start",
            (F.col("start") + F.length("body")).alias("end"),
            "files",
        ).alias("turn"),
    )
    grouped = made.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list("turn")).alias("turns")
    )
    spans = F.transform(
        F.filter("turns", lambda t: t["loss"]),
        lambda t: F.struct(t["at"].alias("turn"), t["start"].alias("start"), t["end"].alias("end")),
    )
    files = F.flatten(F.transform("turns", lambda t: t["files"]))
    return grouped.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("bigint"), lambda total, f: total + f["tokens"]).alias("attachment_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add `read`, the turns (role, text) that the formatted text says, unescaped; placeholders stay as they are."""
    ended = F.split("formatted", r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(ended, 1, F.size(ended) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))

    def parse(body: Column) -> Column:
        head = F.substring_index(body, "\n", 1)
        role = unescape(F.replace(head, F.lit(NEW_LINE), F.lit("\n")))
        text = F.substring(body, F.length(head) + 2, F.length(body))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return formatted.withColumn("read", F.transform(bodies, parse))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted text."""
    read = read_back(formatted)
    said = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.transform("loss_spans", lambda s: F.element_at("read", s["turn"] + 1)["text"])
    return read.select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.array_join(learnt, "").alias("__loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.length("__loss").cast("bigint").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"), "formatted_chars",
    )

"""Chat formatting of typed content parts.

A turn is a list of parts: text, image, audio or document. They are flattened in order.
Text is escaped and stays; any other part becomes a numbered placeholder, and what it
refers to is recorded with the number of tokens that will stand in its place. Turns are
marked by control strings:

    <|im_start|>role
    content<|im_end|>

Inside a text ``<|`` would look like one, so every ``<~...~|`` with any number of ``~``
gets one more: nothing in an escaped text begins a control string, and taking one ``~``
away restores it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.llm.common import let, sums_before

# ---- Fixed values: the template --------------------------------------------------
START = "<|im_start|>"
END = "<|im_end|>"
LINE_IN_ROLE = "<|nl|>"
LEARNT_ROLE = "assistant"
KINDS = ["text", "image", "audio", "document"]
# ----------------------------------------------------------------------------------

# Tokens that stand for a part: one for each patch of an image (its sides rounded up),
# for each started slice of a second of audio, for each page of a document. Text counts
# a token for each started four characters, as an estimate before tokenizing.
PATCH_PIXELS = 14
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 256
CHARACTERS_A_TOKEN = 4
# Code points of a text that a span is looked for in.
BLOCK = 1024

PART = (
    "struct<kind: string, text: string, ref: string, width: int, height: int, "
    "seconds: double, pages: int>"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)\|", "<$1~|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)~\|", "<$1|")


def _header(role: Column) -> Column:
    """A role on one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE_IN_ROLE))


def text_parts(text: Column) -> Column:
    """The parts of a turn that has only text."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


def part_tokens(part: Column) -> Column:
    """Tokens that a part takes once its placeholder is expanded; unknown measures are 0."""

    def patches(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / PATCH_PIXELS)

    return (
        F.when(part["kind"] == "image", patches("width") * patches("height"))
        .when(
            part["kind"] == "audio",
            F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_A_SECOND),
        )
        .when(
            part["kind"] == "document",
            F.coalesce(part["pages"], F.lit(0)) * DOCUMENT_TOKENS_A_PAGE,
        )
        .otherwise(F.ceil(F.length(F.coalesce(part["text"], F.lit(""))) / CHARACTERS_A_TOKEN))
        .cast("long")
    )


def _visit(part: Column, before: Column) -> Column:
    """The text that stands for a part, after ``before`` attachments of its turn."""
    placeholder = F.concat(
        F.lit("<|"), escape(part["kind"]), F.lit("_"), (before + 1).cast("string"), F.lit("|>")
    )
    return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(
        placeholder
    )


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def flatten(turns: DataFrame) -> DataFrame:
    """Per turn its header, ``content`` with placeholders, ``attachments`` and ``tokens``."""
    parts = F.filter(
        F.coalesce("parts", F.expr(f"cast(array() as array<{PART}>)")),
        lambda part: part.isNotNull(),
    )
    visited = F.aggregate(
        "parts",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("count")),
        lambda done, part: F.struct(
            F.concat(done["text"], _visit(part, done["count"])).alias("text"),
            (done["count"] + F.when(_is_text(part), 0).otherwise(1)).alias("count"),
        ),
        lambda done: done["text"],
    )
    attachments = F.transform(
        F.filter("parts", lambda part: ~_is_text(part)),
        lambda part, at: F.struct(
            (at + 1).alias("number"),
            part["kind"].alias("kind"),
            part["ref"].alias("ref"),
            part_tokens(part).alias("tokens"),
        ),
    )
    role = F.coalesce("role", F.lit(""))
    return turns.withColumn("parts", parts).select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.concat(F.lit(START), _header(role), F.lit("\n")).alias("head"),
        visited.alias("content"),
        attachments.alias("attachments"),
        F.aggregate(
            "parts", F.lit(0).cast("long"), lambda n, part: n + part_tokens(part)
        ).alias("tokens"),
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Per conversation of ``turns`` (conv_id, turn, role, parts): conv_id, ``formatted``,
    ``loss_spans`` (start, length in code points of what is learnt: the content of
    assistant turns), ``attachments`` (turn, number, kind, ref, tokens; numbered within
    their turn), ``n_tokens`` with placeholders expanded.

    Turns stand in order of turn, role and content, nulls first, so ties and repeated
    rows have one result. A null role is empty, null parts and texts are empty text, an
    unknown kind of part is an attachment. Null conv_ids are one conversation. A
    conversation is one row of the result, so its turns are gathered, and very long texts
    stay whole. Only the four columns are read, so others may have any name. No turns give no
    rows.
    """
    row = F.struct("turn", "role", "content", "head", "attachments", "tokens")
    gathered = (
        flatten(turns)
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
    )

    def piece(row: Column) -> Column:
        return F.concat(row["head"], row["content"], F.lit(END + "\n"))

    lengths = F.transform("rows", lambda row: F.length(piece(row)))
    placed = F.arrays_zip(let(lengths, sums_before).alias("at"), F.col("rows").alias("row"))
    spans = F.transform(
        F.filter(placed, lambda x: x["row"]["role"] == LEARNT_ROLE),
        lambda x: F.struct(
            (x["at"] + F.length(x["row"]["head"])).alias("start"),
            F.length(x["row"]["content"]).alias("length"),
        ),
    )
    attachments = F.flatten(
        F.transform(
            "rows",
            lambda row: F.transform(
                row["attachments"],
                lambda x: F.struct(
                    row["turn"].alias("turn"), x["number"].alias("number"),
                    x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("rows", piece), "").alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate("rows", F.lit(0).cast("long"), lambda n, row: n + row["tokens"]).alias(
            "n_tokens"
        ),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Per formatted conversation its ``turns`` (role, text) and ``learnt`` texts, parsed
    from ``formatted`` and ``loss_spans`` alone; placeholders stay in the text."""
    pattern = F.lit(r"(?s)<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n")
    roles = F.transform(
        F.regexp_extract_all("formatted", pattern, F.lit(1)),
        lambda role: unescape(F.replace(role, F.lit(LINE_IN_ROLE), F.lit("\n"))),
    )
    texts = F.transform(F.regexp_extract_all("formatted", pattern, F.lit(2)), unescape)

    # The place of a code point is found by counting from the beginning, so spans are cut
    # from the few blocks that they are in and not from the whole text.
    blocks = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def cut(blocks: Column, span: Column) -> Column:
        inside = span["start"] % BLOCK
        number = F.floor(span["start"] / BLOCK).cast("int") + 1
        count = F.floor((inside + span["length"]) / BLOCK).cast("int") + 1
        return F.substr(
            F.array_join(F.slice(blocks, number, count), ""), inside + 1, span["length"]
        )

    learnt = let(
        blocks,
        lambda blocks: F.transform("loss_spans", lambda span: unescape(cut(blocks, span))),
    )
    return chats.withColumns(
        {
            "turns": F.transform(
                F.arrays_zip(roles.alias("role"), texts.alias("text")),
                lambda turn: F.struct(turn["role"].alias("role"), turn["text"].alias("text")),
            ),
            "learnt": learnt,
        }
    )

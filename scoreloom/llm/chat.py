"""Chat formatting: typed content parts flattened into one training string.

A turn's content is an array of parts of the types text, image, audio and document. The
visitor (`_visit`) walks the parts of a turn in order: text is escaped, every other part
becomes its placeholder; its reference and expanded token count are recorded in
`attachments`, numbered in reading order over the whole conversation.

Template: `<s>`, then per turn `[ROLE]` role `[INST]` content `[/INST]`, or for the
roles that the model is trained to produce `[ROLE]` role `[GEN]` content `</s>`. The
loss mask is a list of character spans of the formatted string: the contents of those turns.

Control strings inside a role or text are escaped by a backslash after their first
character (`</s>` becomes `<\\/s>`), after which no text holds a control string; runs of
backslashes at that place grow by one, so that `unescape` is an exact inverse.

Everything is DataFrame functions: one shuffle by conversation carries the window that
numbers and places the turns and the aggregate that joins them. A conversation becomes
one row, since its string is one value.

Defined results: null text is empty; a null role is the empty role; turns of equal number
go by role, then by formatted content; a null turn comes first; rows of a null conv_id
form one conversation; a null part list or an unknown part type contributes nothing, the
latter is counted in `n_unknown_parts`; repeated rows are repeated turns; other columns
of the input are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
BEGIN, ROLE, PROMPT, PROMPT_END, ANSWER, ANSWER_END = "<s>", "[ROLE]", "[INST]", "[/INST]", "[GEN]", "</s>"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
TRAINED = ("assistant",)
_NAMES = r"/?s>|/?INST\]|ROLE\]|GEN\]|IMG\]|AUDIO\]|DOC\]"
_PLAIN = rf"([<\[])(\\*)({_NAMES})"
_ESCAPED = rf"([<\[])\\(\\*)({_NAMES})"

#: Expanded tokens: one per image patch and row end, per audio second, per document page.
PATCH, AUDIO_TOKENS_PER_SECOND, TOKENS_PER_PAGE = 16, 12.5, 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_PLAIN), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def text_parts(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        "array<struct<type:string,text:string>>"
    )


def _field(part: Column, fields: list[str], name: str, kind: str) -> Column:
    return part[name].cast(kind) if name in fields else F.lit(None).cast(kind)


def _visit(parts: Column, fields: list[str]) -> Column:
    """Per part: its string, and for attachments type, reference and expanded tokens."""
    get = lambda p, name, kind: _field(p, fields, name, kind)

    def tokens(p: Column) -> Column:
        patches = lambda size: F.ceil(F.coalesce(size, F.lit(0)) / PATCH)
        rows = patches(get(p, "height", "int"))
        return (
            F.when(p["type"] == "image", rows * (patches(get(p, "width", "int")) + 1))
            .when(p["type"] == "audio", F.ceil(F.coalesce(get(p, "seconds", "double"), F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
            .when(p["type"] == "document", F.coalesce(get(p, "pages", "int"), F.lit(0)) * TOKENS_PER_PAGE)
            .cast("long")
        )

    def visit(p: Column) -> Column:
        string = F.when(p["type"] == "text", escape(F.coalesce(get(p, "text", "string"), F.lit(""))))
        for kind, placeholder in PLACEHOLDERS.items():
            string = string.when(p["type"] == kind, F.lit(placeholder))
        return F.struct(
            F.coalesce(string, F.lit("")).alias("string"),
            F.when(p["type"].isin(*PLACEHOLDERS), p["type"]).alias("type"),
            get(p, "ref", "string").alias("ref"),
            tokens(p).alias("tokens"),
            string.isNull().alias("unknown"),
        )

    return F.transform(parts, visit)


def format_chat(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    parts: str = "parts", trained=TRAINED,
) -> DataFrame:
    """One row per conversation: `formatted`, its length, loss spans and attachments.

    `parts` is an array of structs with `type` and any of the fields of PART.
    """
    fields = turns.schema[parts].dataType.elementType.fieldNames()
    who = F.coalesce(F.col(role), F.lit(""))
    visited = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"),
        _visit(F.col(parts), fields).alias("seen"),
    )
    learn = F.col("role").isin(*trained)
    strings = visited.select(
        "conv_id", "turn", "role",
        F.concat(F.lit(ROLE), escape(F.col("role")), F.when(learn, ANSWER).otherwise(PROMPT)).alias("head"),
        F.coalesce(F.array_join(F.transform("seen", lambda x: x["string"]), ""), F.lit("")).alias("content"),
        F.when(learn, ANSWER_END).otherwise(PROMPT_END).alias("tail"),
        learn.alias("learn"),
        F.filter("seen", lambda x: x["type"].isNotNull()).alias("attached"),
        F.coalesce(F.size(F.filter("seen", lambda x: x["unknown"])), F.lit(0)).alias("unknown"),
    )
    size = F.length("head") + F.length("content") + F.length("tail")
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    placed = strings.select(
        "*",
        F.row_number().over(ordered).alias("n"),
        (F.lit(len(BEGIN)) + F.sum(size).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - size).alias("at"),
    )
    span = F.struct(
        (F.col("at") + F.length("head")).alias("start"),
        (F.col("at") + F.length("head") + F.length("content")).alias("end"),
    )
    piece = F.struct(
        "n", F.concat("head", "content", "tail").alias("string"), F.when(F.col("learn"), span).alias("loss"),
        F.transform("attached", lambda x: F.struct(x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens"))).alias("attached"),
    )
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"), F.sum("unknown").alias("n_unknown_parts")
    )
    listed = F.flatten(F.transform("pieces", lambda x: F.coalesce(x["attached"], F.array().cast("array<struct<type:string,ref:string,tokens:bigint>>"))))
    whole = whole.select(
        "conv_id",
        F.size("pieces").cast("long").alias("n_turns"),
        F.concat(F.lit(BEGIN), F.array_join(F.transform("pieces", lambda x: x["string"]), "")).alias("formatted"),
        F.filter(F.transform("pieces", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.transform(
            listed,
            lambda x, i: F.struct((i + 1).alias("number"), x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].alias("tokens")),
        ).alias("attachments"),
        F.col("n_unknown_parts").cast("long").alias("n_unknown_parts"),
    )
    return whole.withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x["tokens"], F.lit(0)))
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Parses `formatted` into `turns` (role, text) and cuts out the text under the loss mask.

    Placeholders come back as their placeholder strings.
    """
    chunks = F.split("formatted", r"\[ROLE\]")
    chunks = F.slice(chunks, F.lit(2), F.size(chunks))

    def turn(chunk: Column) -> Column:
        halves = F.split(chunk, r"\[INST\]|\[GEN\]", 2)
        body = F.regexp_replace(F.get(halves, F.lit(1)), r"(\[/INST\]|</s>)$", "")
        return F.struct(unescape(F.get(halves, F.lit(0))).alias("role"), unescape(body).alias("text"))

    loss = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return formatted.select("*", F.transform(chunks, turn).alias("turns"), F.array_join(loss, "").alias("loss_text"))

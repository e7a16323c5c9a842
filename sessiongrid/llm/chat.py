"""Chat formatting with typed content parts; built-in functions only.

Each message is an array of parts {type, text, uri, width, height, seconds, pages}. A visitor of the parts flattens
them in order: text is escaped, other kinds become placeholders numbered through the conversation, whose
references and expanded token counts are recorded. Messages are wrapped as

    <|turn|>role NEWLINE content <|end|>

Texts and roles write "&" as ``&amp;`` and "<" as ``&lt;`` (roles write a line end as ``&#10;``), so "<" stands in control
strings alone and parsing is exact whatever the texts say. Loss spans cover the assistant's contents.

Turns are ordered by (turn, role, content), nulls first; repeated rows are repeated turns; a null text, role, part or
list of parts counts as empty; unknown kinds of part become an empty placeholder of no tokens. Rows without a
conversation id form one conversation. An empty table gives no conversation. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
#: Expansion: an image has a token for each patch, a clip for each frame, a document a fixed number for a page.
IMAGE_PATCH, AUDIO_TOKENS_PER_SECOND, TOKENS_PER_PAGE = 14, 25, 256
LOSS_ROLE = "assistant"
#: Code points that are searched through for a place in a text.
BLOCK = 16384


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def expanded_tokens(part: Column) -> Column:
    patches = lambda side: F.ceil(F.coalesce(part[side], F.lit(0)) / F.lit(IMAGE_PATCH))
    return (
        F.when(part["type"] == "image", patches("width") * patches("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * TOKENS_PER_PAGE)
        .otherwise(F.lit(0))
        .cast("long")
    )


def _is_media(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) != "text"


def _placeholder(part: Column, number: Column) -> Column:
    return F.concat(F.lit("<|"), escape(part["type"]), F.lit(":"), number.cast("string"), F.lit("|>"))


def format_conversations(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """messages (conv_id, turn, role, parts) -> a row for each conversation.

    formatted: the text; loss_spans: start and length in code points; attachments: placeholder, kind, uri and expanded
    tokens; expanded_tokens: their sum. Each turn is written in its own row; running sums over the conversation's turns
    number its attachments and give its place. A conversation is one value of the result, so its turns meet in one
    row at last, by the same shuffle; nothing grows turn by turn.
    """
    given = F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    order = ["turn", "role", "given"]
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), given.alias("given"))
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    n_media = F.size(F.filter("given", _is_media))
    rows = rows.withColumn("first", F.coalesce(F.sum(n_media).over(before), F.lit(0)))
    # positions of the turn's attachments; the place of a part among them is its number
    media = F.filter(F.sequence(F.lit(0), F.size("given")), lambda k: _is_media(F.get("given", k)) & F.get("given", k).isNotNull())
    visit = F.transform(F.array(media), lambda at: F.concat_ws("", F.transform("given", lambda p, k: F.when(_is_media(p), _placeholder(p, F.col("first") + F.array_position(at, k) - 1)).otherwise(escape(F.coalesce(p["text"], F.lit("")))))))
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    found = F.transform(F.filter("given", _is_media), lambda p, k: F.struct(_placeholder(p, F.col("first") + k).alias("placeholder"), p["type"].alias("kind"), p["uri"].alias("uri"), expanded_tokens(p).alias("tokens")))
    rows = rows.select("conv_id", *order, head.alias("head"), visit[0].alias("content"), found.alias("found"))
    size = (F.length("head") + F.length("content") + len(END)).cast("long")
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    rows = rows.select("conv_id", F.struct(number.alias("k"), F.coalesce(F.sum(size).over(before), F.lit(0)).alias("at"), "head", "content", (F.col("role") == LOSS_ROLE).alias("loss"), "found").alias("piece"))
    pieces = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    spans = F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: F.struct((p["at"] + F.length(p["head"])).cast("int").alias("start"), F.length(p["content"]).alias("length")))
    attachments = F.flatten(F.col("pieces.found"))
    return pieces.select(
        "conv_id",
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["content"], F.lit(END)))).alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role and content (placeholders stay as they are)."""
    turns = F.filter(F.split(formatted, r"<\|turn\|>"), lambda t: t != "")
    bare = F.transform(turns, lambda t: F.substring(t, F.lit(1), F.length(t) - len(END)))
    return F.transform(bare, lambda t: F.struct(unescape_role(F.substring_index(t, "\n", 1)).alias("role"), unescape(F.substring(t, F.length(F.substring_index(t, "\n", 1)) + 2, F.length(t))).alias("content")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    Places in UTF-8 are found by counting from the front, so spans are read from blocks of BLOCK code points.
    """
    count = F.floor(F.length(formatted) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count), lambda j: F.substring(formatted, j * BLOCK + 1, F.lit(BLOCK)))

    def within(blocks: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / BLOCK).cast("int"), F.floor((s["start"] + s["length"]) / BLOCK).cast("int")

        def part(j: Column) -> Column:
            low = F.greatest(s["start"], j * BLOCK)
            return F.substring(F.get(blocks, j), low - j * BLOCK + 1, F.least(s["start"] + s["length"], (j + 1) * BLOCK) - low)

        return F.concat_ws("", F.transform(F.sequence(first, last), part))

    # the list of blocks is bound to a variable, so that it is made once for all spans
    texts = F.transform(F.array(blocks), lambda b: F.concat_ws("", F.transform(spans, lambda s: unescape(within(b, s)))))
    return texts[0]


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted text and its spans say of each conversation."""
    rows = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))))
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

"""Chat formatting with typed content parts.

A visitor goes over the parts of every turn: a text is escaped, an image, a piece of audio or a document becomes a
placeholder, and its reference and the number of tokens that the placeholder stands for are recorded. The k-th
placeholder of a conversation belongs to its k-th attachment.

A turn is ``<turn>role<says>content</turn>``. Where a role or a text holds a control string, or one that is escaped
already, one backslash more goes behind its ``<``; taking one away gives the text back. The loss mask is a list of
(skip, take) runs over the output. Such lists of neighbouring turns just follow one another, so turns are rendered row by
row, joined in blocks of a conversation, and only then to whole conversations: a very long one reaches its last task as a
few long rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, CLOSE, PAD = "<turn>", "<says>", "</turn>", "<pad/>"
KINDS = ("image", "audio", "document", "other")
CONTROLS = (OPEN, SAYS, CLOSE, PAD, *(f"<{k}/>" for k in KINDS))
_TAILS = "|".join(c[1:] for c in CONTROLS)
#: Turns of a conversation that are joined first.
BLOCK = 64
#: Tokens of an image tile of so many pixels a side (and of the whole image once), of a second of audio, of a page.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 448, 256, 25, 512
PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
MASK = "array<struct<skip:int,take:int>>"
ATTACHMENT = "struct<kind:string,uri:string,tokens:long>"


def escape(text: Column) -> Column:
    """The text without any control string."""
    return F.regexp_replace(text, rf"<(\\*)({_TAILS})", r"<$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"<\\(\\*)({_TAILS})", "<$1$2")


def text_parts(text: Column) -> Column:
    """A plain text as typed parts."""
    names = [x.split(":") for x in PART[7:-1].split(",")]
    return F.array(F.struct(*((F.lit("text") if n == "kind" else F.coalesce(text, F.lit("")) if n == "text" else F.lit(None)).cast(k).alias(n) for n, k in names)))


def placeholder_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; unknown sizes count as the least one of their kind."""
    side = lambda c: F.greatest(F.ceil(F.coalesce(part[c], F.lit(1)) / F.lit(TILE)), F.lit(1))
    tiles = side("width") * side("height")
    return (
        F.when(part["kind"] == "image", (tiles + F.when(tiles > 1, 1).otherwise(0)) * TILE_TOKENS)
        .when(part["kind"] == "audio", F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * SECOND_TOKENS), F.lit(1)))
        .when(part["kind"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * PAGE_TOKENS).otherwise(0).cast("long")
    )


def _kind(part: Column) -> Column:
    return F.when(part["kind"].isin("text", *KINDS), part["kind"]).otherwise("other")


def visit(messages: DataFrame, *, conversation: str, turn: str, role: str, content: str, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rendered turns (conversation, turn, text, mask, attachments), a row for each row of ``messages``.

    The mask takes the text parts of turns of a ``trained`` role. A null role, text or list of parts is empty.
    """
    parts = F.filter(F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    said = F.transform(parts, lambda p: F.struct(_kind(p).alias("kind"), F.when(p["kind"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<"), _kind(p), F.lit("/>"))).alias("shown"), p["uri"].alias("uri"), placeholder_tokens(p).alias("tokens")))
    rows = messages.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), said.alias("said"))
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SAYS))
    size = lambda p: F.char_length(p["shown"])
    loss = F.transform("said", lambda p: F.struct(F.when(p["kind"] == "text", 0).otherwise(size(p)).alias("skip"), F.when(p["kind"] == "text", size(p)).otherwise(0).alias("take")))
    total = F.aggregate("said", F.lit(0), lambda n, p: n + size(p))
    run = lambda skip, take: F.array(F.struct(skip.cast("int").alias("skip"), take.cast("int").alias("take")))
    none = F.lit(0)
    mask = F.when(F.col("role").isin(*trained), F.concat(run(F.char_length(head), none), loss, run(F.lit(len(CLOSE)), none))).otherwise(run(F.char_length(head) + total + len(CLOSE), none))
    attached = F.transform(F.filter("said", lambda p: p["kind"] != "text"), lambda p: F.struct(p["kind"].alias("kind"), p["uri"].alias("uri"), p["tokens"].alias("tokens")))
    text = F.concat(head, F.array_join(F.col("said.shown"), ""), F.lit(CLOSE))
    return rows.select("conversation", "turn", text.alias("text"), mask.cast(MASK).alias("mask"), attached.cast(f"array<{ATTACHMENT}>").alias("attachments"))


def _joined(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of a key in order: texts one behind the other, masks and attachments likewise."""
    rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).isNotNull(), order, "text", "mask", "attachments", "turns"))).alias("rows"))
    return rows.select(*keys, F.array_join("rows.text", "").alias("text"), F.flatten("rows.mask").alias("mask"), F.flatten("rows.attachments").alias("attachments"), F.aggregate("rows.turns", F.lit(0).cast("long"), lambda a, n: a + n).alias("turns"))


def format_chats(messages: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content", trained: tuple[str, ...] = ("assistant",), block: int = BLOCK) -> DataFrame:
    """(conversation, formatted, mask, attachments, turns), a row for each conversation.

    Turns are ordered by ``turn``, those without one first; rows of one turn by their rendered text, and repeated rows
    all stay. Rows without a conversation make one of their own. An empty table gives no rows; columns other than the
    four named are not read, whatever their names.
    """
    rendered = visit(messages, conversation=conversation, turn=turn, role=role, content=content, trained=trained)
    blocks = rendered.withColumn("block", F.floor(F.col("turn") / F.lit(block))).withColumn("turns", F.lit(1).cast("long"))
    whole = _joined(_joined(blocks, ["conversation", "block"], "turn"), ["conversation"], "block")
    return whole.select(F.col("conversation").alias(conversation), F.col("text").alias("formatted"), "mask", "attachments", "turns")


def turns_of(formatted: Column) -> Column:
    """Turns read back from an output: array of (role, content); attachments stand as placeholders."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(pieces, lambda p: F.struct(unescape(F.substring_index(F.substring(p, len(OPEN) + 1, F.char_length(p)), SAYS, 1)).alias("role"), unescape(F.substring_index(p, SAYS, -1)).alias("content")))


def taken(formatted: Column, mask: Column) -> Column:
    """The parts of an output under its mask, unescaped, in order.

    Runs are taken in about sqrt(n) groups of sqrt(n), each from a piece of its own, so a conversation of very many
    turns is not gone over from its start for every run.
    """
    runs = F.filter(mask, lambda m: m["skip"] + m["take"] > 0)
    side = F.greatest(F.ceil(F.sqrt(F.size(runs))), F.lit(1)).cast("int")
    groups = F.transform(F.sequence(F.lit(0), F.greatest(F.size(runs) - 1, F.lit(0)), side), lambda i: F.slice(runs, i + 1, side))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<piece:string,runs:{MASK}>>").alias("out"))

    def piece(acc: Column, g: Column) -> Column:
        length = F.aggregate(g, F.lit(0), lambda n, m: n + m["skip"] + m["take"])
        return F.struct((acc["at"] + length).alias("at"), F.array_append(acc["out"], F.struct(F.substring(formatted, acc["at"] + 1, length).alias("piece"), g.cast(MASK).alias("runs"))).alias("out"))

    def parts(x: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        one = lambda acc, m: F.struct((acc["at"] + m["skip"] + m["take"]).alias("at"), F.when(m["take"] > 0, F.array_append(acc["out"], unescape(F.substring(x["piece"], acc["at"] + m["skip"] + 1, m["take"])))).otherwise(acc["out"]).alias("out"))
        return F.aggregate(x["runs"], first, one, lambda acc: acc["out"])

    return F.flatten(F.transform(F.aggregate(groups, start, piece, lambda acc: acc["out"]), parts))


def expand(formatted: Column, attachments: Column) -> Column:
    """The output with every placeholder written out as that many pad tokens."""
    pieces = F.split(formatted, f"<(?:{'|'.join(KINDS)})/>")
    pads = F.transform(attachments, lambda a: F.repeat(F.lit(PAD), a["tokens"].cast("int")))
    return F.array_join(F.flatten(F.transform(F.arrays_zip(pieces.alias("p"), pads.alias("n")), lambda z: F.array(F.coalesce(z["p"], F.lit("")), F.coalesce(z["n"], F.lit(""))))), "")


ORACLE_SQL = rf"""WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(regexp_replace(role, '<(\\*)({_TAILS})', '<\1\\\2', 'g')) + length(regexp_replace(text, '<(\\*)({_TAILS})', '<\1\\\2', 'g')) + {len(OPEN + SAYS + CLOSE)} AS size FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS placeholder_tokens FROM e GROUP BY conv_id"""

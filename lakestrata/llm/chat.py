"""Chat formatting of typed content parts; DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them in order into one string:
texts with their control strings escaped, the others as a placeholder; it records each attachment's reference, its place
among the parts and how many tokens the placeholder stands for. The template then marks the turns::

    <s>[INST]role[/INST]content</s>

Escapes are reversible: ``~`` becomes ``~0`` and control string number k becomes ``~k``. Control strings are escaped after the parts are joined, so
also one that only arises where two text parts meet; until then an attachment is a mark that no text can hold, as a text's ``~`` is followed by 0. No
control string contains ``~``, and none can arise across the edge of a text and a mark, so the output splits at its marks without doubt.

Defined results: null text, role or part list is empty; parts of another type count as text; turns of one conversation
with equal numbers are ordered by role, then content; a null turn comes first; null conversation ids form one
conversation; repeated rows are repeated turns. A conversation is one string, so it must fit a task; others do not
meet it there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's control strings in the order of their escapes ~1, ~2, ...
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
CONTROL = [BEGIN, END, OPEN, CLOSE, *PLACEHOLDERS.values()]
LEARNED = "assistant"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 14, 25, 512


ESCAPES = [(c, f"~{k}") for k, c in enumerate(CONTROL, 1)]
MARKS = {kind: f"~!{kind}!" for kind in PLACEHOLDERS}


def replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column) -> Column:
    return replaced(text, [("~", "~0"), *ESCAPES])


def unescape(text: Column) -> Column:
    return replaced(text, [*((e, c) for c, e in ESCAPES), ("~0", "~")])


def flattened(strings: Column) -> Column:
    """The content of a turn from its parts' strings."""
    return replaced(F.array_join(strings, ""), [*ESCAPES, *((MARKS[kind], shown) for kind, shown in PLACEHOLDERS.items())])


def text_part(text: Column) -> Column:
    """A list of one text part."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            *(F.lit(None).cast(t).alias(n) for n, t in empty.items())))


def tokens(part: Column) -> Column:
    """Tokens that an attachment's placeholder stands for: patches, frames or pages."""
    def at_least_one(x):
        return F.greatest(F.lit(1), F.coalesce(x, F.lit(1))).cast("long")
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    return (F.when(part["type"] == "image", at_least_one(patches))
            .when(part["type"] == "audio", at_least_one(F.ceil(part["seconds"] * FRAMES_PER_SECOND)))
            .when(part["type"] == "document", at_least_one(part["pages"] * TOKENS_PER_PAGE)).otherwise(F.lit(0).cast("long")))


def visit(parts: Column) -> Column:
    """What becomes of each part: its string, to be flattened, and, for an attachment, reference, place and tokens."""
    def one(part, place):
        mark = reduce(lambda c, kv: c.when(part["type"] == kv[0], F.lit(kv[1])), MARKS.items(), F)
        known = F.coalesce(part["type"].isin(list(PLACEHOLDERS)), F.lit(False))
        text = F.replace(F.coalesce(part["text"], F.lit("")), F.lit("~"), F.lit("~0"))
        return F.struct(F.when(known, mark.otherwise(F.lit(None))).otherwise(text).alias("string"),
                        known.alias("attached"), place.alias("place"), part["type"].alias("type"), part["ref"].alias("ref"),
                        F.when(known, tokens(part)).otherwise(F.lit(0).cast("long")).alias("tokens"))
    return F.transform(F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()), one)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans, attachments, attachment_tokens``.

    ``loss_spans`` are the places (code points from 0, end exclusive) of the contents to learn, ``attachments`` are in the order
    of their placeholders with the number of their turn in the conversation from 0.
    """
    seen = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        visit(F.col(parts_col)).alias("parts"))
    content = flattened(F.transform("parts", lambda p: p["string"]))
    attached = F.transform(F.filter("parts", lambda p: p["attached"]), lambda p: F.struct(p["place"], p["type"], p["ref"], p["tokens"]))
    marked = (seen.withColumn("content", content).withColumn("head", F.concat(F.lit(BEGIN + OPEN), escape(F.col("role")), F.lit(CLOSE)))
              .withColumn("attached", attached).withColumn("string", F.concat("head", "content", F.lit(END))).drop("parts"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    before = F.coalesce(F.sum(F.length("string")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = marked.withColumn("n", F.row_number().over(order)).withColumn("start", before + F.length("head"))
    rows = (placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "n", "string", "attached", (F.col("role") == LEARNED).alias("learned"), "start", F.length("content").alias("size")))).alias("t")))
    spans = F.transform(F.filter("t", lambda t: t["learned"]), lambda t: F.struct(t["start"].alias("start"), (t["start"] + t["size"]).alias("end")))
    every = F.flatten(F.transform("t", lambda t: F.transform(t["attached"], lambda a: F.struct(
        (t["n"] - 1).alias("turn"), a["place"].alias("place"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return (rows.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                        F.array_join(F.transform("t", lambda t: t["string"]), "").alias("formatted"),
                        spans.alias("loss_spans"), every.alias("attachments"))
            .withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and content as the parts had them."""
    def turn(piece):
        head = F.split(F.substring(piece, len(BEGIN + OPEN) + 1, 1 << 30), r"\[/INST\]", 2)
        return F.struct(unescape(head[0]).alias("role"), unescape(head[1]).alias("text"))
    return F.transform(F.filter(F.split(formatted, END), lambda piece: piece != ""), turn)


def digests(chats: DataFrame) -> DataFrame:
    """Read everything back from the output and digest it."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
        "formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return (chats.withColumn("turns", read_back(F.col("formatted"))).withColumn("learned", learned)
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))

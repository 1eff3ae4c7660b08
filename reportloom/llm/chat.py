"""Chat formatting with typed content parts, in SQL expressions only.

A message is a list of parts: text, image, audio or document. They are flattened in order into one text, attachments as
numbered placeholders, and each attachment is recorded with the tokens it will expand to. Turns are marked by control
strings; the same strings inside texts and roles are escaped, so that formatting can be undone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Escapes, applied in this order and undone in reverse: every control string and placeholder begins with <|.
ESCAPES = (("&", "&amp;"), ("<|", "&lt;|"))
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,milliseconds:long,pages:int>"
PARTS = f"array<{PART}>"
PATCH = 28  # pixels of a side of an image token
AUDIO_TOKEN = 40  # milliseconds
PAGE_TOKENS = 600


def escaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescaped(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def escaped_role(role: Column) -> Column:
    """A role's line ends at the first line break."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("ref", "string"), ("width", "int"), ("height", "int"), ("milliseconds", "long"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *none)).cast(PARTS)


def expanded_tokens(part: Column) -> Column:
    """Tokens of an attachment; sizes that are not known count as nothing. Other kinds are one token."""
    up = lambda a, n: F.ceil(F.coalesce(a, F.lit(0)) / n)
    return (F.when(part["kind"] == "image", up(part["width"], PATCH) * up(part["height"], PATCH)).when(part["kind"] == "audio", up(part["milliseconds"], AUDIO_TOKEN))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS).otherwise(1)).cast("long")


def flattened(parts: Column) -> Column:
    """The visitor: walks over parts in order and gives text, with placeholders numbered from 0, and attachments."""
    shape = "struct<text:string,attachments:array<struct<kind:string,ref:string,tokens:long>>>"
    start = F.struct(F.lit("").alias("text"), F.array().cast("array<struct<kind:string,ref:string,tokens:long>>").alias("attachments")).cast(shape)

    def visit(a: Column, part: Column) -> Column:
        mark = F.concat(F.lit("<|"), F.regexp_replace(F.coalesce(part["kind"], F.lit("part")), "[^a-z_]", "_"), F.lit(":"), F.size(a["attachments"]).cast("string"), F.lit("|>"))
        is_text = F.coalesce(part["kind"] == "text", F.lit(False))
        found = F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), expanded_tokens(part).alias("tokens"))
        return F.struct(F.concat(a["text"], F.when(is_text, escaped(F.coalesce(part["text"], F.lit("")))).otherwise(mark)).alias("text"),
                        F.when(is_text, a["attachments"]).otherwise(F.concat(a["attachments"], F.array(found))).alias("attachments")).cast(shape)

    return F.aggregate(F.coalesce(parts, F.array().cast(PARTS)), start, visit)


def format_chats(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row for each conversation of messages (conv_id, turn, role, parts).

    Returns conv_id, formatted, loss (spans of code points: from, to excluded, of the trained role's contents),
    attachments (message, kind, ref, tokens) and attachment_tokens. Messages are ordered by turn, then by role and
    content; a null turn comes first, a null role is an empty one, null parts are none. Repeated rows are repeated
    messages. Rows without a conv_id are one conversation. Other columns are left out.
    """
    flat = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), flattened(F.col("parts").cast(PARTS)).alias("f"))
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    size = F.length(head) + F.length("f.text") + len(END + "\n")
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "f").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a message's end within the conversation is its place in the order too; a running sum finds all of them in one pass
    placed = flat.withColumn("end", F.sum(size).over(before).cast("int"))
    chats = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("end", "role", "f"))).alias("m"))
    block = lambda m: F.concat(F.lit(START), escaped_role(m["role"]), F.lit("\n"), m["f"]["text"], F.lit(END + "\n"))

    def span(m: Column) -> Column:
        last = m["end"] - len(END + "\n")
        return F.struct((last - F.length(m["f"]["text"])).alias("from"), last.alias("to"))

    loss = F.transform(F.filter("m", lambda m: m["role"] == trained_role), span)
    files = F.flatten(F.transform("m", lambda m, i: F.transform(m["f"]["attachments"], lambda x: F.struct(
        i.alias("message"), x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens")))))
    out = chats.select("conv_id", F.array_join(F.transform("m", block), "").alias("formatted"), loss.alias("loss"), files.alias("attachments"))
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and text as they were, placeholders unchanged."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p, i: i > 0)
    role = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substr(p, F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 1 - len(END + "\n"))
    return F.transform(pieces, lambda p: F.struct(unescaped_role(role(p)).alias("role"), unescaped(body(p)).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substr(formatted, s["from"] + 1, s["to"] - s["from"]))), "")

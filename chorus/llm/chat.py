"""Chat formatting with Spark expressions only: collected turns become one marked string and a loss mask.

Inside a text every backslash is doubled and ``<|`` becomes ``<\\|``, so no
control string can occur in it, and reading back undoes both. Adjacent turns of
one role share a block; a separator mark keeps them apart, so nothing is lost.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"
ROLE_BREAK = "<\\n|"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(ROLE_BREAK))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(ROLE_BREAK), F.lit("\n")))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``formatted`` and ``loss_spans``.

    ``turns`` needs ``conv_id, turn, role, text``; other columns are ignored.
    Turns are sorted by number, then role, then text, so ties and repeated rows
    have one order. A null role or text is empty, a null turn number comes
    first, and rows without a ``conv_id`` form one conversation of their own.
    ``loss_spans`` holds start (from 0) and length, in code points of
    ``formatted``, of every non-empty text of the trained role. The turns of one
    conversation meet in one row, as the format demands.
    """
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ))).alias("turns")
    )
    t = F.col("turns")
    starts = F.filter(
        F.sequence(F.lit(1), F.size(t)),
        lambda i: (i == 1) | (F.get(t, i - 1)["role"] != F.get(t, i - 2)["role"]),
    )
    bounded = collected.select("conv_id", "turns", starts.alias("starts"))
    s = F.col("starts")

    def block(start: Column, k: Column) -> Column:
        upto = F.coalesce(F.get(s, k + 1), F.size(t) + 1)
        mine = F.slice(t, start, upto - start)
        return F.struct(
            F.get(t, start - 1)["role"].alias("role"),
            F.transform(mine, lambda x: escape(x["text"])).alias("texts"),
        )

    merged = bounded.select("conv_id", F.transform(s, block).alias("blocks"))

    def render(b: Column) -> Column:
        return F.concat(
            F.lit(START), _escape_role(b["role"]), F.lit("\n"), F.array_join(b["texts"], NEXT), F.lit(END)
        )

    empty = F.array().cast("array<struct<start:bigint,length:bigint>>")

    def spans_of(b: Column, at: Column) -> Column:
        """Spans of one block: add up the lengths of its texts from where the block stands."""
        first = at + len(START) + F.length(_escape_role(b["role"])) + 1
        return F.aggregate(
            b["texts"],
            F.struct(first.cast("bigint").alias("at"), empty.alias("spans")),
            lambda acc, x: F.struct(
                (acc["at"] + F.length(x) + len(NEXT)).alias("at"),
                F.when(F.length(x) == 0, acc["spans"]).otherwise(F.concat(acc["spans"], F.array(F.struct(
                    acc["at"].alias("start"), F.length(x).cast("bigint").alias("length")
                )))).alias("spans"),
            ),
            lambda acc: acc["spans"],
        )

    rendered = merged.select("conv_id", "blocks", F.transform("blocks", render).alias("lines"))
    spans = F.aggregate(
        F.arrays_zip(F.col("blocks"), F.col("lines")),
        F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["lines"])).alias("at"),
            F.when(
                x["blocks"]["role"] == TRAINED_ROLE, F.concat(acc["spans"], spans_of(x["blocks"], acc["at"]))
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return rendered.select("conv_id", F.array_join("lines", "").alias("formatted"), spans.alias("loss_spans"))


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation, as array of (role, text)."""
    blocks = F.array_remove(F.split(formatted, r"<\|im_end\|>\n", -1), "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(role) + 2)
        named = _unescape_role(F.substr(role, F.lit(len(START) + 1)))
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda x: F.struct(named.alias("role"), unescape(x).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, spans: Column) -> Column:
    """What the loss mask covers, unescaped, in order."""
    pieces = F.transform(
        spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(pieces, "")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`format_chats` wrote, read back from its output."""
    read = formatted.select(
        "conv_id", "formatted",
        read_chats(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said = F.array_join(
        F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )

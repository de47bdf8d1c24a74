"""Chat formatting with Spark expressions only.

A conversation is written as blocks, one for each run of adjacent turns of the same role:

    [INST] role [/INST]text<s>text</s>

`<s>` stands between the merged turns of a block. Inside roles and texts a backslash is doubled and each control string
gets a backslash after its first character, so the blocks can be read back without loss.

Defined results: null text and null role are empty; rows with a null conv_id form one conversation; turns sort by turn
(null first), then role, then text, so ties and repeated rows are deterministic and each row stays a turn; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
BEGIN, MIDDLE, NEXT, END = "[INST] ", " [/INST]", "<s>", "</s>"
CONTROL = ["[INST]", "[/INST]", "<s>", "</s>"]


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for word in CONTROL:
        out = F.replace(out, F.lit(word), F.lit(word[0] + "\\" + word[1:]))
    return out


def unescape(text: Column) -> Column:
    out = text
    for word in CONTROL:
        out = F.replace(out, F.lit(word[0] + "\\" + word[1:]), F.lit(word))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments.

    `segments` cuts `formatted` into consecutive pieces, each with its loss flag: exactly the texts of `loss_role` are under
    the mask, neither markers nor the separators of merged turns.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn"), text("role").alias("role"), text("text").alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def starts_block(t: Column, i: Column) -> Column:
        return (i == 0) | (F.get("turns", i - 1)["role"] != t["role"])

    # 1-based positions at which a role begins, and the end of the last run
    starts = F.filter(F.transform("turns", lambda t, i: F.when(starts_block(t, i), i + 1)), lambda p: p.isNotNull())
    runs = sorted_turns.withColumn("starts", F.concat(starts, F.array(F.size("turns") + 1)))
    merged = runs.withColumn("blocks", F.transform(
        F.slice("starts", 1, F.size("starts") - 1),
        lambda s, i: F.struct(F.get("turns", s - 1)["role"].alias("role"),
                              F.transform(F.slice("turns", s, F.get("starts", i + 1) - s), lambda t: t["text"]).alias("texts"))))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def pieces(block: Column) -> Column:
        masked = block["role"] == loss_role
        head = F.concat(F.lit(BEGIN), escape(block["role"]), F.lit(MIDDLE))
        return F.concat(
            F.flatten(F.transform(block["texts"], lambda t, i: F.array(
                segment(F.when(i == 0, head).otherwise(F.lit(NEXT)), F.lit(False)), segment(escape(t), masked)))),
            F.array(segment(F.lit(END), F.lit(False))))

    cut = merged.select("conv_id", F.flatten(F.transform("blocks", pieces)).alias("segments"))
    return cut.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, "</s>", -1), lambda b: b.startswith(BEGIN))

    def turns(block: Column) -> Column:
        inner = F.substring(block, len(BEGIN) + 1, 2147483647)
        role = F.substring_index(inner, MIDDLE, 1)
        texts = F.split(F.substring(inner, F.length(role) + len(MIDDLE) + 1, F.length(inner)), "<s>", -1)
        return F.transform(texts, lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest(chats: DataFrame) -> DataFrame:
    """Read every formatted conversation back and digest turns and loss text."""
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                        loss_text(F.col("segments")).alias("loss"), F.size("segments").alias("n_segments"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))

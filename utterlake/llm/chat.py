"""Chat formatting by prefix-target expansion, in DataFrame functions alone.

Every turn becomes a segment of its conversation's formatted text:

    <|im_start|>role\\ntext<|im_end|>\\n

Inside roles and texts a backslash is written \\s and a less-than sign \\l, so no text can hold a control string, and
the writing can be undone; in roles a line feed is written \\n as well. Every assistant turn becomes an example: its
context is all that precedes its reply, and only the reply is trainable.

prompts() writes examples with their contexts spelled out, which m turns make m * m / 2 texts of context. examples() names a
context by length, the first context_chars code points of its conversation's formatted text, for whoever wants output that
stays linear. read_back() compares either form's contexts with the segments. Running lengths come from a window over each
conversation, which Spark sorts on disk if need be; only prompts() and read_back() gather a conversation in a row.

Defined cases: a null text or role is empty; turns are ordered by (turn, role, text), nulls first, so equal turns keep a
fixed order; a null conv_id is a conversation of its own; other columns are ignored; a conversation without an
assistant turn gives segments but no example; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END, NL = "<|im_start|>", "<|im_end|>\n", "\n"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    """Text without control strings; unescape() gives it back."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(NL), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit(NL)))


def format_turns(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each turn: conv_id, seq (from 0), segment, before (code points of all earlier segments), and where in
    the segment its trainable text lies: loss_at and loss_chars, null unless an assistant speaks."""
    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit(NL))
    body = escape(F.col("text"))
    trained = F.col("role") == TRAINED
    said = said.withColumns({"segment": F.concat(head, body, F.lit(END)), "loss_at": F.when(trained, F.length(head).cast("long")), "loss_chars": F.when(trained, F.length(body).cast("long"))})
    total = F.sum(F.length("segment").cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0))
    return said.select(
        "conv_id",
        (F.row_number().over(order) - 1).alias("seq"),
        "segment",
        (total - F.length("segment")).alias("before"),
        "loss_at",
        "loss_chars",
    )


def examples(formatted: DataFrame) -> DataFrame:
    """One row for each assistant turn of format_turns(): conv_id, seq, context_turns, context_chars, target."""
    return formatted.where(F.col("loss_at").isNotNull()).select(
        "conv_id",
        "seq",
        F.col("seq").alias("context_turns"),
        (F.col("before") + F.col("loss_at")).alias("context_chars"),
        F.substring("segment", F.col("loss_at").cast("int") + 1, F.col("loss_chars").cast("int")).alias("target"),
    )


def prompts(formatted: DataFrame) -> DataFrame:
    """Examples with their contexts spelled out: conv_id, seq, context, target. Quadratic in a conversation's turns by nature."""
    e = _with_whole(examples(formatted), formatted)
    return e.select("conv_id", "seq", F.substring("_all", F.lit(1), F.col("context_chars").cast("int")).alias("context"), "target")


def _with_whole(rows: DataFrame, formatted: DataFrame) -> DataFrame:
    """rows with their conversation's formatted text as _all."""
    # never null, so that the texts stay where they were put together
    key = {"_none": F.col("conv_id").isNull(), "_conv": F.coalesce(F.col("conv_id").cast("string"), F.lit(""))}
    whole = formatted.withColumns(key).groupBy(*key).agg(_in_order("segment").alias("_all"))
    return rows.withColumns(key).join(whole, [*key]).drop(*key)


def _in_order(column: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct("seq", column)))
    return F.array_join(F.transform(pairs, lambda p: p[column]), "")


def read_back(formatted: DataFrame, trained: DataFrame) -> DataFrame:
    """Digests of each conversation, from format_turns() and prompts() or examples() alone.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed for each turn), loss_chars and loss_sha256 (the targets,
    unescaped, in order), formatted_chars (code points of the formatted conversation). A digest runs over a whole
    conversation, so here each conversation's text comes together in one row. An example fails the query unless its context is
    the conversation's text up to its reply (by length and SHA-256): a beginning of it that opens seq + 1 turns, ends in the
    speaker's line, and is followed by the target and its end mark.
    """
    pattern = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n$"
    parts = formatted.select(
        "conv_id",
        "seq",
        F.concat(unescape_role(F.regexp_extract("segment", pattern, 1)), F.lit(NL), unescape(F.regexp_extract("segment", pattern, 2)), F.lit(NL)).alias("piece"),
        F.length("segment").cast("long").alias("chars"),
        F.lit(None).cast("string").alias("loss"),
    )
    own = F.col("context") if "context" in trained.columns else F.lit(None).cast("string")
    size = F.length("context").cast("long") if "context" in trained.columns else F.col("context_chars")
    # a context goes to its conversation as its length and digest, so what is shuffled stays linear
    tried = _with_whole(trained.select("conv_id", "seq", "target", size.alias("_n"), F.sha2(own, 256).alias("_digest")), formatted)
    context = F.substring("_all", F.lit(1), F.col("_n").cast("int"))
    opened = F.length(context) - F.length(F.replace(context, F.lit(START), F.lit("")))
    same = F.col("_digest").isNull() | (F.col("_digest") == F.sha2(context, 256))
    right = same & F.startswith(F.col("_all"), F.concat(context, "target", F.lit(END))) & F.endswith(context, F.lit(f"{START}{TRAINED}{NL}")) & (opened == (F.col("seq") + 1) * len(START))
    loss = F.when(right, unescape(F.col("target"))).otherwise(F.raise_error(F.lit("an example's context is not what precedes its reply")).cast("string"))
    losses = tried.select("conv_id", "seq", F.lit(None).cast("string").alias("piece"), F.lit(0).cast("long").alias("chars"), loss.alias("loss"))
    return (
        parts.unionByName(losses)
        .groupBy("conv_id")
        .agg(
            F.count("piece").alias("n_turns"),
            F.sha2(_in_order("piece"), 256).alias("turns_sha256"),
            F.coalesce(F.sum(F.length("loss").cast("long")), F.lit(0).cast("long")).alias("loss_chars"),
            F.sha2(_in_order("loss"), 256).alias("loss_sha256"),
            F.sum("chars").alias("formatted_chars"),
        )
    )

"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context, and only
the reply itself is trainable. Turns after the last reply (or all, if there is none) make one more
example without a target, so nothing of a conversation is lost. DataFrame functions only.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is
put into every ``<|``, ``<\\|``, ``<\\\\|`` ..., and ``\\n`` in a role becomes ``<\\n|``; both can
be undone, and no control string survives inside a text.

Defined cases: null texts and roles are empty; turns are ordered by (turn, role, text), null
turns first; repeated rows stay; null conversation ids form one conversation; an empty table gives
no examples; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<n|"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<n|"), F.lit("\n")))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): one row per trainable reply.

    ``[loss_start, loss_end)`` are code points of ``text``; empty for the rest without a target.
    One conversation is gathered as one value, since its examples contain all of its turns.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            cell("role").alias("role"),
            cell("text").alias("text"),
        ).alias("turn"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    heads = whole.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == TRAINED_ROLE).alias("target"),
                F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ).alias("parts"),
    )
    steps = heads.select(
        "conv_id",
        "parts",
        F.filter(
            F.sequence(F.lit(1), F.size("parts")),
            lambda k: F.get("parts", k - 1)["target"] | (k == F.size("parts")),
        ).alias("ends"),
    ).select("conv_id", "parts", F.posexplode("ends").alias("example", "end"))
    before = F.concat(
        F.array_join(
            F.transform(
                F.slice("parts", F.lit(1), F.col("end") - 1),
                lambda p: F.concat(p["head"], p["body"], F.lit(END)),
            ),
            "",
        ),
        F.get("parts", F.col("end") - 1)["head"],
    )
    last = F.get("parts", F.col("end") - 1)
    placed = steps.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        before.alias("_before"),
        last["body"].alias("_body"),
        last["target"].alias("_target"),
    )
    start = F.length("_before").cast("long")
    return placed.select(
        "conv_id",
        "example",
        F.concat("_before", "_body", F.lit(END)).alias("text"),
        start.alias("loss_start"),
        F.when(F.col("_target"), start + F.length("_body")).otherwise(start).alias("loss_end"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and trained text per conversation, from the formatted examples alone.

    The longest example (the last) holds every turn. The result has ``turns`` (role, text) and
    ``losses``, the unescaped text under each example's mask, in order.
    """
    masked = F.substring(
        "text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")
    )
    each = formatted.select(
        "conv_id",
        "example",
        F.length("text").cast("long").alias("chars"),
        "text",
        unescape(masked).alias("loss"),
    )
    gathered = each.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.max_by("text", "example").alias("longest"),
    )
    pieces = F.filter(F.split("longest", r"<\|im_start\|>"), lambda p: p != "")
    end = len(END)
    return gathered.select(
        "conv_id",
        "formatted_chars",
        F.transform("losses", lambda x: x["loss"]).alias("losses"),
        F.transform(
            pieces,
            lambda p: F.struct(
                _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
                unescape(
                    F.substring(
                        p,
                        F.instr(p, "\n") + 1,
                        F.length(p) - end - F.instr(p, "\n"),
                    )
                ).alias("text"),
            ),
        ).alias("turns"),
    )

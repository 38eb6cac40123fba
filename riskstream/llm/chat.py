r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, its text is
the only trainable part. Turns after the last assistant turn (or a conversation without one) make
a last example in which nothing is trainable, so no turn is lost.

Template of a turn: ``<s>[INST]`` role ``[/INST]`` text ``</s>``. Every control string starts with
``<`` or ``[``; inside roles and texts these two and the backslash are followed by a backslash, so
no control string can stand there, and taking out that backslash gives the text back.

Conversations of any number are spread by ``conv_id``. One conversation is one unit: its examples
repeat its own turns, so its formatted size is at most turns x its length.

Defined cases: null text and null role are empty; a null ``conv_id`` is a conversation of its own;
turns are in order of ``turn`` (null first), then role, then text; repeated rows stay; an empty
table gives no examples; extra columns are left out, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, NAMED, CLOSE = "<s>[INST]", "[/INST]", "</s>"
#: The role whose turns are trained.
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def expand(conversations: DataFrame, trained: str = TRAINED) -> DataFrame:
    """``conv_id, example, formatted, mask``: one row per example.

    ``example`` counts from 0 within the conversation. ``mask`` lists the trainable spans as
    (start, end) in code points of ``formatted``, end exclusive.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    marked = F.transform(
        "_turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape(t["role"]), F.lit(NAMED)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == F.lit(trained)).alias("trained"),
        ),
    )
    # Index of each example's last turn, from 1.
    ends = F.filter(
        F.sequence(F.lit(1), F.size("_marked")),
        lambda i: F.element_at("_marked", i)["trained"] | (i == F.size("_marked")),
    )
    last = F.element_at("_marked", F.col("_end"))
    context = F.concat(
        F.array_join(
            F.transform(
                F.slice("_marked", F.lit(1), F.col("_end") - 1),
                lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)),
            ),
            "",
        ),
        last["head"],
    )
    start = F.length("_context")
    span = F.struct(start.alias("start"), (start + F.length("_body")).alias("end"))
    return (
        whole.withColumn("_marked", marked)
        .select("conv_id", "_marked", F.posexplode(ends).alias("example", "_end"))
        .select(
            "conv_id",
            "example",
            context.alias("_context"),
            last["body"].alias("_body"),
            last["trained"].alias("_trained"),
        )
        .select(
            "conv_id",
            "example",
            F.concat("_context", "_body", F.lit(CLOSE)).alias("formatted"),
            F.when(F.col("_trained"), F.array(span)).otherwise(F.array().cast(_MASK)).alias("mask"),
        )
    )


_MASK = "array<struct<start:int,end:int>>"


def turns_of(formatted: Column) -> Column:
    """The turns of an example, read back: array of (role, text)."""
    pieces = F.split(formatted, CLOSE)
    head = F.lit(len(OPEN) + 1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(
                F.substring(F.substring_index(p, NAMED, 1), head, F.length(p))
            ).alias("role"),
            unescape(F.substring_index(p, NAMED, -1)).alias("text"),
        ),
    )


def trained_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, read back."""
    return F.array_join(
        F.transform(
            mask, lambda m: unescape(F.substring(formatted, m["start"] + 1, m["end"] - m["start"]))
        ),
        "",
    )


def digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, derived from its examples alone.

    The turns are read back from the last example, which holds all of them.
    """
    read = examples.select(
        "conv_id",
        "example",
        "formatted",
        trained_text(F.col("formatted"), F.col("mask")).alias("_loss"),
    )
    each = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("_whole"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("example", "_loss"))), lambda x: x["_loss"]
            ),
            "",
        ).alias("_loss"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    listed = F.array_join(
        F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return each.withColumn("_turns", turns_of(F.col("_whole"))).select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )

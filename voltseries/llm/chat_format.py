r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it as context, and the
span of its own text as the only trainable part. Turns after the last assistant
turn come as a last example without a trainable span, so nothing is lost.

Template of a turn, followed by a line break: ``### role: text </turn>``. Inside role
and text the characters of the control strings are written as ``\b`` (backslash),
``\h`` (#), ``\l`` (<) and, in roles, ``\c`` (:). A formatted text therefore holds no
bare ``#`` or ``<`` but those of the template, and unescaping gives the text back.

Defined cases: a null text or role is empty; turns are ordered by turn (null first),
role and text, so repeated rows stay; a null conv_id is one conversation; a
conversation without an assistant turn is one example without a target. Other
columns are ignored. A conversation is one value, as its digest is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, TAIL = "### ", ": ", " </turn>\n"
TRAINED_ROLE = "assistant"
# Fixed values of the template: the character and its escape, in writing order.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))


def escaped(text: Column, in_role: bool = False) -> Column:
    for plain, code in ESCAPES if in_role else ESCAPES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, in_role: bool = False) -> Column:
    """Inverse of ``escaped``; the backslash comes last, as it leads every code."""
    for plain, code in reversed(ESCAPES if in_role else ESCAPES[:3]):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def training_examples(turns: DataFrame) -> DataFrame:
    """conv_id, example_no, is_last, text, target_start, target_chars.

    The target is ``target_chars`` code points of ``text`` from ``target_start`` (0-based);
    both are null for an example that only has context. ``is_last`` marks the example
    that holds all turns of its conversation.
    """
    clean = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    opened = F.concat(F.lit(HEAD), escaped(F.col("role"), True), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    pieces = clean.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(opened, body, F.lit(TAIL)).alias("piece"),
            F.length(opened).alias("lead"),
            F.length(body).alias("chars"),
        ).alias("p"),
    )
    # One struct per turn, in order, with the end of the text so far.
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    placed = whole.select(
        "conv_id",
        F.array_join(F.transform("ps", lambda p: p["piece"]), "").alias("full"),
        F.aggregate(
            "ps",
            F.expr(
                "named_struct('at', 0L, 'ends', cast(array() as array<struct<start:bigint,chars:bigint,stop:bigint>>))"
            ),
            lambda s, p: F.struct(
                (s["at"] + F.length(p["piece"])).alias("at"),
                F.when(
                    p["role"] == TRAINED_ROLE,
                    F.concat(
                        s["ends"],
                        F.array(
                            F.struct(
                                (s["at"] + p["lead"]).alias("start"),
                                p["chars"].cast("long").alias("chars"),
                                (s["at"] + F.length(p["piece"])).alias("stop"),
                            )
                        ),
                    ),
                )
                .otherwise(s["ends"])
                .alias("ends"),
            ),
        ).alias("s"),
    )
    none = F.lit(None).cast("long")
    stop = F.coalesce(F.try_element_at("s.ends", F.lit(-1))["stop"], F.lit(-1))
    rest = F.struct(none.alias("start"), none.alias("chars"), F.col("s.at").alias("stop"))
    spans = F.when(stop == F.col("s.at"), F.col("s.ends")).otherwise(F.concat("s.ends", F.array(rest)))
    return (
        placed.select("conv_id", "full", spans.alias("spans"))
        .select("conv_id", "full", F.size("spans").alias("k"), F.posexplode("spans").alias("example_no", "e"))
        .select(
            "conv_id",
            "example_no",
            (F.col("example_no") == F.col("k") - 1).alias("is_last"),
            F.substring("full", F.lit(1), F.col("e.stop").cast("int")).alias("text"),
            F.col("e.start").alias("target_start"),
            F.col("e.chars").alias("target_chars"),
        )
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    parts = F.split(F.substring(text, F.lit(1), F.length(text) - len(TAIL)), TAIL, -1)
    head = F.length(F.lit(HEAD))

    def turn(part: Column) -> Column:
        cut = F.instr(part, MIDDLE)
        return F.struct(
            unescaped(F.substring(part, head + 1, cut - head - 1), True).alias("role"),
            unescaped(F.substring(part, cut + len(MIDDLE), F.length(part))).alias("text"),
        )

    return F.transform(parts, turn)


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of the turns and of the trainable text, per conversation, from the examples."""
    line = F.lit("\n")
    target = F.substring("text", F.col("target_start").cast("int") + 1, F.col("target_chars").cast("int"))
    turns = F.when(F.col("is_last"), read_turns(F.col("text")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    parts = (
        examples.withColumn("turns", turns)
        .select(
            "conv_id",
            F.struct("example_no", F.coalesce(unescaped(target), F.lit("")).alias("loss")).alias("part"),
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(flat, 256).alias("turns_sha256"),
            F.length("text").cast("long").alias("chars"),
            "is_last",
        )
        .withColumn("n_turns", F.when(F.col("is_last"), F.col("n_turns")))
    )
    loss = F.array_join(F.transform(F.sort_array("loss"), lambda p: p["loss"]), "")
    return (
        parts.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.collect_list("part").alias("loss"),
            F.sum("chars").alias("formatted_chars"),
            F.count(F.lit(1)).alias("n_examples"),
        )
        .withColumn("loss", loss)
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
            "n_examples",
        )
    )

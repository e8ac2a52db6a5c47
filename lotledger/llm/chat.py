"""Dialogues of several speakers, rendered once from the view of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotledger.llm.arrays import ranked

#: Turns in a row of the result. A longer dialogue has more rows.
PART = 64
SYSTEM, NOBODY = "system", "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _safe(c: Column) -> Column:
    """Text in which no marker can begin."""
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part: int = PART) -> DataFrame:
    """A row per dialogue, participant and part: `conv_id`, `speaker`, `part`, `n_turns`, `rendered`, `mask`.

    The speaker's turns are the assistant's, all others' are a user's with a name;
    system turns stay the system's, and the system is no participant. `mask` holds
    the spans to learn (start:end in code points, end exclusive, comma-joined): the
    speaker's words and the marker that closes them.

    Turns are ordered by turn, role and text; repeated rows are all rendered. The
    parts of a dialogue, one after the other, are the whole; so a dialogue of any
    length is never gathered in one task. Null text is empty, a null role is the
    participant "unknown", a null conv_id is a dialogue of its own, a null turn
    comes first. A dialogue of system turns alone has no rows.
    """
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(NOBODY)).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    placed, sizes = ranked(rows, order, "turns")
    before, at = {}, 0
    for r in sorted(sizes.collect(), key=lambda r: r["part"]):
        before[r["part"]] = at
        at += r["n"]
    shift = turns.sparkSession.createDataFrame(list(before.items()), "part int, shift bigint")
    placed = placed.join(F.broadcast(shift), "part").withColumn("at", F.col("pos") + F.col("shift"))
    first = placed.groupBy("conv_id").agg(F.min("at").alias("first"))
    numbered = placed.join(first.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")))
    blocks = (
        numbered.groupBy("conv_id", F.floor((F.col("at") - F.col("first")) / part).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    )
    people = placed.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    views = blocks.join(people, F.col("conv_id").eqNullSafe(F.col("_conv")))

    def head(t: Column) -> Column:
        name = F.regexp_replace(t["role"], r"[^0-9A-Za-z_\-]", "_")
        who = F.when(t["role"] == F.col("speaker"), F.lit("assistant")).when(t["role"] == SYSTEM, F.lit("system")).otherwise(F.concat(F.lit("user name="), name))
        return F.concat(F.lit(OPEN), who, F.lit("\n"))

    pieces = F.transform("turns", lambda t: F.struct(head(t).alias("head"), F.concat(_safe(t["text"]), F.lit(CLOSE)).alias("body"), (t["role"] == F.col("speaker")).alias("own")))
    laid = views.withColumn("pieces", pieces)

    def span(p: Column, i: Column) -> Column:
        done = F.aggregate(F.slice("pieces", F.lit(1), i), F.lit(0), lambda n, q: n + F.length(q["head"]) + F.length(q["body"]))
        start = done + F.length(p["head"])
        return F.when(p["own"], F.concat(start.cast("string"), F.lit(":"), (start + F.length(p["body"])).cast("string")))

    return laid.select(
        "conv_id", "speaker", "part", F.size("pieces").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        F.concat_ws(",", F.transform("pieces", span)).alias("mask"),
    )

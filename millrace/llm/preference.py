"""Preference formatting: chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns (same place, role and text) is the prompt and is rendered once; what follows on
either side is a completion, whose trained spans are the contents of assistant turns. All of it is grouping by (pair,
turn) and by pair with partial aggregation; a conversation is never gathered as a whole: an output row holds at most
PART_TURNS turn numbers, and longer conversations continue in further parts. A common first turn is no key, so it is no
hot spot.

Nulls: a null role or text is empty, a null turn comes first (as turn -1), a null pair is a pair. Rows that repeat a
turn exactly are one turn; other rows of the same number follow each other by role and text. A pair with one side has
an empty prompt and that side's completion; equal sides give a prompt alone. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_TURNS = 256
#: The marks around a turn.
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def _rendered(turns: Column) -> Column:
    """(text, spans) of ordered turns: spans are `first:last` of assistant contents, comma-joined."""

    def add(a: Column, t: Column) -> Column:
        head = F.concat(a["text"], F.lit(OPEN), t["role"], F.lit(MIDDLE))
        span = F.concat(F.length(head).cast("string"), F.lit(":"), (F.length(head) + F.length(t["text"])).cast("string"))
        spans = F.when(t["role"] != "assistant", a["spans"]).when(a["spans"] == "", span).otherwise(F.concat(a["spans"], F.lit(","), span))
        return F.struct(F.concat(head, t["text"], F.lit(CLOSE)).alias("text"), spans.alias("spans"))

    return F.aggregate(turns, F.struct(F.lit("").alias("text"), F.lit("").alias("spans")), add)


def format_pairs(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """turns: pair_id, side (chosen or rejected), turn, role, text. Returns pair_id, part, n_prompt_turns, prompt, chosen,
    chosen_spans, rejected, rejected_spans; offsets are of the part's completion, in code points."""
    clean = turns.select("pair_id", "side", F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    place = clean.withColumn("sub", F.row_number().over(Window.partitionBy("pair_id", "side", "turn").orderBy("role", "text")))
    side = lambda name: F.max(F.when(F.col("side") == name, F.struct("role", "text"))).alias(name)
    met = place.groupBy("pair_id", "turn", "sub").agg(side("chosen"), side("rejected"))
    at = F.struct("turn", "sub")
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    first = met.groupBy("pair_id").agg(F.min(F.when(differs, at)).alias("first")).withColumnRenamed("pair_id", "_pair")
    told = met.join(first, F.col("pair_id").eqNullSafe(F.col("_pair"))).withColumn("common", F.col("first").isNull() | (at < F.col("first")))
    turn = lambda x: F.struct("turn", "sub", F.col(f"{x}.role").alias("role"), F.col(f"{x}.text").alias("text"))
    gathered = told.groupBy("pair_id", F.floor(F.col("turn") / part_turns).cast("long").alias("part")).agg(
        F.sort_array(F.collect_list(F.when(F.col("common"), turn("chosen")))).alias("p"),
        F.sort_array(F.collect_list(F.when(~F.col("common") & F.col("chosen").isNotNull(), turn("chosen")))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("common") & F.col("rejected").isNotNull(), turn("rejected")))).alias("r"),
    )
    shown = gathered.select("pair_id", "part", F.size("p").cast("long").alias("n_prompt_turns"), _rendered(F.col("p")).alias("p"), _rendered(F.col("c")).alias("c"), _rendered(F.col("r")).alias("r"))
    return shown.select("pair_id", "part", "n_prompt_turns", F.col("p.text").alias("prompt"), F.col("c.text").alias("chosen"), F.col("c.spans").alias("chosen_spans"), F.col("r.text").alias("rejected"), F.col("r.spans").alias("rejected_spans"))


def neighbours(conversations: DataFrame) -> DataFrame:
    """Conversations 2k and 2k+1 as the chosen and the rejected side of pair k; a null conv_id is a chosen side."""
    odd = F.coalesce(F.pmod("conv_id", F.lit(2)) == 1, F.lit(False))
    return conversations.select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), F.when(odd, "rejected").otherwise("chosen").alias("side"), "turn", "role", "text")

"""Operator 9, preference formatting: the common turn prefix once as prompt, then two masked completions.

Native DataFrame code on turn rows: the prefix ends at the first turn that only one side has, so no
conversation is gathered into one value and one very long conversation spans many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"  # markers of the rendered turns (parameters of render)


def render(role: Column, text: Column, open_: str = OPEN, close: str = CLOSE) -> Column:
    """One turn as ``<open>role\\ntext<close>\\n``; ``<|`` inside role or text is parted, so it cannot forge a marker."""
    safe = [F.replace(F.coalesce(c, F.lit(d)), F.lit("<|"), F.lit("< |")) for c, d in ((role, "user"), (text, ""))]
    return F.concat(F.lit(open_), safe[0], F.lit("\n"), safe[1], F.lit(close + "\n"))


def preference_pairs(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Format paired conversations for preference training.

    ``turns``: pair_id, side ('chosen' or 'rejected'), turn, role, text. Returns one row per rendered
    turn: pair_id, part ('prompt', 'chosen', 'rejected'), turn, role, text (rendered), trained (true for
    turns of ``trained_role`` in a completion; everything else is masked). A part is its rows' texts in
    order of turn, then role and text. The prompt holds the turns before the first (turn, role, text) that
    only one side has, and appears once per pair.

    Defined cases: exactly repeated turns count once; several different turns under one number stay, in
    order of role and text; a null turn comes before all others; null role renders as user, null text as
    empty. Rows with a null pair or another side take no part; a pair with one side only gives no rows;
    equal conversations give a prompt and no completions. Extra columns play no part.
    """
    t = turns.where(F.col("pair_id").isNotNull() & F.col("side").isin("chosen", "rejected")).select(
        "pair_id", F.col("turn").cast("long").alias("turn"), "role", "text", (F.col("side") == "chosen").alias("c"))
    one = t.groupBy("pair_id", "turn", "role", "text").agg(F.max("c").alias("c"), F.max(~F.col("c")).alias("r"))
    low = F.lit(-(1 << 63)).cast("long")
    one = one.withColumn("at", F.coalesce("turn", low))
    pairs = one.groupBy(F.col("pair_id").alias("p")).agg(
        F.min(F.when(F.col("c") != F.col("r"), F.col("at"))).alias("cut"), F.max("c").alias("pc"), F.max("r").alias("pr")).where("pc and pr")
    both = one.join(pairs, F.col("pair_id") == F.col("p"))
    prompt = F.col("cut").isNull() | (F.col("at") < F.col("cut"))
    part = F.when(prompt, F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("c"), F.lit("chosen")), F.when(F.col("r"), F.lit("rejected"))), lambda x: x.isNotNull()))
    out = both.withColumn("part", F.explode(part))
    return out.select(
        "pair_id", "part", "turn", "role", render(F.col("role"), F.col("text")).alias("text"),
        ((F.col("part") != "prompt") & F.coalesce(F.col("role") == trained_role, F.lit(False))).alias("trained"))


def assemble(rows: DataFrame) -> DataFrame:
    """Join rendered turns into one string per pair and part, for conversations known to fit a row."""
    key = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    return rows.groupBy("pair_id", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["text"]), "").alias("text"))

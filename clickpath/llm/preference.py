"""Preference formatting: longest common turn prefix once as prompt, paired masked completions.

A conversation is an array of (role, text) turns in order.  For a pair, the
turns that both conversations share from the start are rendered once as the
prompt; what follows in each is its completion, with character spans of the
assistant turns (the only ones a loss may see).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickpath.llm.columns import let

# The chat template
OPEN, CLOSE = "<|", "|>\n"
END = "<|end|>\n"
LEARNT_ROLE = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns (array of role, text), by turn number, then role and text.

    Null roles and texts count as empty; rows without a conv_id are left out;
    a row repeated with the same turn, role and text counts once.
    """
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    return (turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("r"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_set("r")).alias("r"))
            .select("conv_id", F.transform("r", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of equal turns at the start of both arrays."""
    differs = F.filter(F.sequence(F.lit(0), F.least(F.size(a), F.size(b))),
                       lambda i: ~F.coalesce(F.get(a, i) == F.get(b, i), F.lit(False)))
    return F.array_min(differs).cast("int")


def turn_text(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE), turn["text"], F.lit("\n" + END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, turn_text), "")


def learnt_spans(turns: Column) -> Column:
    """[start, end) of the text and end mark of every assistant turn in the rendered turns, in code points."""
    lengths = F.transform(turns, lambda t: F.length(turn_text(t)))
    empty = F.array().cast("array<struct<start:int,end:int,learnt:boolean>>")

    def step(acc: Column, i: Column, size: Column) -> Column:
        begin = F.coalesce(F.get(acc, F.size(acc) - 1)["end"], F.lit(0))
        learnt = F.get(turns, i)["role"] == LEARNT_ROLE
        return F.concat(acc, F.array(F.struct(begin.alias("start"), (begin + F.get(size, i)).alias("end"), learnt.alias("learnt"))))

    all_spans = let(lengths, lambda size: F.aggregate(
        F.transform(size, lambda x, i: i), empty, lambda acc, i: step(acc, i, size)))
    header = len(OPEN) + len(CLOSE) + len(LEARNT_ROLE)
    return F.transform(F.filter(all_spans, lambda s: s["learnt"]), lambda s: F.struct(
        (s["start"] + header).alias("start"), s["end"].alias("end")))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Rows (.., chosen, rejected) of turn arrays -> (.., n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask).

    A pair whose conversations are equal, or where one starts with the whole
    other one, gets an empty completion and an empty mask on that side.
    """
    n = F.col("n_prompt_turns")
    tail = lambda side: F.slice(side, n + 1, F.greatest(F.size(side) - n, F.lit(0)))
    rest = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    cut = pairs.withColumn("n_prompt_turns", common_prefix(F.col("chosen"), F.col("rejected")))
    cut = cut.select(*rest, "n_prompt_turns", F.slice("chosen", 1, n).alias("shared"), tail("chosen").alias("c"), tail("rejected").alias("r"))
    return cut.select(*rest, "n_prompt_turns", render(F.col("shared")).alias("prompt"), render(F.col("c")).alias("chosen"),
                      render(F.col("r")).alias("rejected"), learnt_spans(F.col("c")).alias("chosen_mask"),
                      learnt_spans(F.col("r")).alias("rejected_mask"))


def pair_up(convs: DataFrame) -> DataFrame:
    """(conv_id, other_id, chosen, rejected) for every conversation.

    Conversations that open with the same turn compete: the one with most
    turns (then the smallest id) is chosen, and every other one is rejected
    once against it.  The chosen one, and any without a rival, is paired with
    itself where the last assistant turn is answered by the one before it
    (an empty answer if there is none); other_id is then null.
    """
    opened = convs.withColumn("opening", F.xxhash64(F.get("turns", F.lit(0))["role"], F.get("turns", F.lit(0))["text"]))
    best = opened.groupBy("opening").agg(F.min(F.struct((-F.size("turns")).alias("n"), F.col("conv_id").alias("best_id"))).alias("b"))
    best = best.select("opening", F.col("b.best_id").alias("best_id"))
    ranked = opened.join(best, "opening")
    champion = convs.select(F.col("conv_id").alias("best_id"), F.col("turns").alias("chosen"))
    rivals = (ranked.where("conv_id <> best_id").select("conv_id", "best_id", F.col("turns").alias("rejected"))
              .join(champion, "best_id").select("conv_id", F.col("best_id").alias("other_id"), "chosen", "rejected"))
    answers = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == LEARNT_ROLE, i).otherwise(F.lit(-1))), lambda i: i >= 0)
    last, before = F.element_at("answers", -1), F.get("answers", F.size("answers") - 2)
    swapped = F.transform("turns", lambda t, i: F.when(F.col("last").eqNullSafe(i), F.struct(
        t["role"].alias("role"), F.coalesce(F.get("turns", F.col("before"))["text"], F.lit("")).alias("text"))).otherwise(t))
    alone = (ranked.where("conv_id = best_id").withColumn("answers", answers)
             .withColumn("last", F.when(F.size("answers") > 0, last)).withColumn("before", before)
             .select("conv_id", F.lit(None).cast("long").alias("other_id"), F.col("turns").alias("chosen"), swapped.alias("rejected")))
    return rivals.unionByName(alone)


def preference_examples(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, other_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.

    See :func:`conversations` for nulls and repeated rows; an empty table gives no rows.
    """
    return format_pairs(pair_up(conversations(turns)))

"""Preference examples: one shared prompt, two completions, and what of each is trained on.

DataFrame functions only.  A conversation is one example and hence one row: its turns are
gathered, ordered and rendered within that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .staging import unused

# The marks of the published ChatML layout.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def turn_lists(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", turns_as: str = "turns") -> DataFrame:
    """Rows ``(conv_id, turns array<struct<role, text>>)``, turns in order; ties by role, then text; a null turn number comes first."""
    each = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    listed = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(each)).alias(turns_as))
    return listed.withColumn(turns_as, F.transform(turns_as, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def common_turns(a: Column, b: Column) -> Column:
    """The number of leading turns that two lists share; null equals null."""
    same = F.zip_with(
        a, b, lambda x, y: F.coalesce(x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]), F.lit(False))
    )
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("int")


def _plain(c: Column) -> Column:
    """Text that cannot be taken for a mark of the layout."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn["role"]), F.lit("\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _plain(t["text"]), F.lit(CLOSE))), "")


def mask(turns: Column, trained_role: str = "assistant") -> Column:
    """Run lengths in characters over the rendered turns: ``length:1`` is trained on, ``length:0`` is not.

    Trained on are an assistant's words and the mark that ends them, never a heading.
    """
    def runs(t: Column) -> Column:
        head, body = F.length(_head(t)), F.length(_plain(t["text"])) + len(CLOSE)
        of_role = F.coalesce(t["role"] == trained_role, F.lit(False))
        return F.when(of_role, F.concat(head.cast("string"), F.lit(":0,"), body.cast("string"), F.lit(":1"))).otherwise(F.concat((head + body).cast("string"), F.lit(":0")))

    return F.array_join(F.transform(turns, runs), ",")


def preference_examples(pairs: DataFrame, chosen: str = "chosen_turns", rejected: str = "rejected_turns", trained_role: str = "assistant") -> DataFrame:
    """``pairs`` with its two turn lists replaced by ``n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    The prompt is the longest common prefix of whole turns; the completions are the turns
    after it.  Equal lists give empty completions, lists that differ at once an empty prompt;
    a null list counts as empty; repeated rows stay.  Other columns stay, but must not have
    the names that are made, in any case.  An empty input gives an empty result.
    """
    made = ("n_prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")
    kept = [c for c in pairs.columns if c not in (chosen, rejected)]
    if clash := sorted(c for c in kept if c.lower() in made):
        raise ValueError(f"the input already has columns {clash}; rename them")
    none = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none)
    p_, a_, b_, n = (*unused(pairs, "p_", "a_", "b_"), "n_prompt_turns")
    cut = pairs.select(*kept, a.alias(a_), b.alias(b_), common_turns(a, b).alias(n))
    rest = lambda c: F.slice(c, F.col(n) + 1, F.greatest(F.size(c) - F.col(n), F.lit(0)))
    cut = cut.select(*kept, n, F.slice(a_, 1, F.col(n)).alias(p_), rest(F.col(a_)).alias(a_), rest(F.col(b_)).alias(b_))
    return cut.select(
        *kept, n, rendered(F.col(p_)).alias("prompt"), rendered(F.col(a_)).alias("chosen"), rendered(F.col(b_)).alias("rejected"),
        mask(F.col(a_), trained_role).alias("chosen_mask"), mask(F.col(b_), trained_role).alias("rejected_mask"),
    )


def with_curtailed_answer(listed: DataFrame, turns: str = "turns", role: str = "assistant") -> DataFrame:
    """Pairs out of single conversations: against each stands itself with its last answer cut after the first sentence."""
    t = F.col(turns)
    last = F.array_max(F.transform(t, lambda x, i: F.when(x["role"] == role, i)))
    short = F.transform(t, lambda x, i: F.struct(x["role"].alias("role"), F.when(i == last, F.substring_index(x["text"], ". ", 1)).otherwise(x["text"]).alias("text")))
    return listed.select(*[c for c in listed.columns if c != turns], t.alias("chosen_turns"), short.alias("rejected_turns"))

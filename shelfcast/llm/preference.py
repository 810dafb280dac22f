"""Preference formatting for chat data, in DataFrame expressions only.

A pair is a chosen and a rejected conversation, each an array of (role, text) turns. Their
longest common prefix of turns is rendered once, as the prompt; what follows it is rendered for each
side with a mask: the character ranges of the assistant's texts, which alone are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<role:string,text:string>"


def rendered(turn: Column) -> Column:
    """``<|role|>``, newline, text, ``<|end|>``, newline. A null role is empty, as is a null text."""
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"), F.coalesce(turn["text"], F.lit("")), F.lit("<|end|>\n"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns, equal in role and text (nulls equal), that both have."""
    differ = F.transform(F.arrays_zip(chosen.alias("a"), rejected.alias("b")),
                         lambda z: ~(z["a"]["role"].eqNullSafe(z["b"]["role"]) & z["a"]["text"].eqNullSafe(z["b"]["text"])))
    shorter = F.least(F.size(chosen), F.size(rejected))
    at = F.array_position(differ, True)
    return F.when(at > 0, F.least(at - 1, shorter)).otherwise(shorter).cast("int")


def trained_ranges(turns: Column) -> Column:
    """start:end of each assistant text in the rendered turns, comma-joined; code points."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(F.coalesce(t["role"], F.lit(""))) + 5
        end = begin + F.length(F.coalesce(t["text"], F.lit("")))
        here = F.array(F.concat_ws(":", begin.cast("string"), end.cast("string")))
        return F.struct((end + 8).alias("at"), F.when(t["role"] == "assistant", F.concat(a["out"], here)).otherwise(a["out"]).alias("out"))

    return F.aggregate(turns, start, step, lambda a: F.array_join(a["out"], ","))


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` without its two arrays plus prompt, prompt_turns, chosen_text, chosen_mask,
    rejected_text and rejected_mask. Null conversations are empty ones."""
    none = F.array().cast(f"array<{TURN}>")
    c, r = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none)
    known = pairs.withColumn("_n", common_turns(c, r))
    text = lambda a: F.array_join(F.transform(a, rendered), "")
    rest = lambda a: F.slice(a, F.col("_n") + 1, F.size(a))
    own = [F.col(f"`{x}`") for x in pairs.columns if x not in (chosen, rejected)]
    return known.select(*own, F.col("_n").alias("prompt_turns"), text(F.slice(c, 1, F.col("_n"))).alias("prompt"),
                        text(rest(c)).alias("chosen_text"), trained_ranges(rest(c)).alias("chosen_mask"),
                        text(rest(r)).alias("rejected_text"), trained_ranges(rest(r)).alias("rejected_mask"))


def assemble(turns: DataFrame) -> DataFrame:
    """conv_id, turns (in order of turn, then role, then text) of a table of single turns.

    Rows without a conv_id belong to no conversation and are left out; a null turn comes first.
    """
    return (turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """A pair for each conversation with an assistant turn: chosen is the conversation; rejected is
    the same up to its last assistant turn, and then the last assistant text of the conversation
    with the next higher id by one (an answer to something else). Where that one is missing or
    has no answer, the rejected side ends before the turn.
    """
    conv = assemble(turns)
    is_answer = F.transform("turns", lambda t: F.coalesce(t["role"] == "assistant", F.lit(False)))
    last = F.size("turns") - F.array_position(F.reverse(is_answer), True) + 1
    conv = conv.withColumn("_last", F.when(F.array_contains(is_answer, True), last).cast("int"))
    other = conv.where(F.col("_last").isNotNull()).select((F.col("conv_id") - 1).alias("conv_id"),
                                                          F.array(F.element_at("turns", F.col("_last"))).alias("_answer"))
    joined = conv.where(F.col("_last").isNotNull()).join(other, "conv_id", "left")
    answer = F.coalesce("_answer", F.array().cast(f"array<{TURN}>"))
    return joined.select("conv_id", F.col("turns").alias("chosen"),
                         F.concat(F.slice("turns", 1, F.col("_last") - 1), answer).alias("rejected"))


def op5(conversations: DataFrame) -> DataFrame:
    return format_preferences(neighbour_pairs(conversations))


def _sql_text(turns: str) -> str:
    return (f"array_to_string(list_transform({turns}, lambda t: '<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '')"
            " || '<|end|>' || chr(10)), '')")


def _sql_mask(turns: str) -> str:
    size = "length(coalesce(x.role, '')) + length(coalesce(x.text, '')) + 13"
    before = f"coalesce(list_sum(list_transform({turns}[1:i - 1], lambda x: {size})), 0)"
    begin = f"({before} + length(coalesce({turns}[i].role, '')) + 5)"
    return (f"array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: {turns}[i].role = 'assistant'),"
            f" lambda i: cast({begin} as bigint) || ':' || cast({begin} + length(coalesce({turns}[i].text, '')) as bigint)), ',')")


#: DuckDB oracle of ``op5``.
OP5_SQL = f"""
with c as (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role nulls first, text nulls first) as turns
  from conversations where conv_id is not null group by conv_id),
l as (
  select *, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) as last from c),
p as (
  select a.conv_id, a.turns as chosen,
    list_concat(a.turns[1:a.last - 1], case when b.last is null then [] else [b.turns[b.last]] end) as rejected
  from l a left join l b on b.conv_id = a.conv_id + 1 where a.last is not null),
n as (
  select *, cast(coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1), lambda i:
      chosen[i].role is distinct from rejected[i].role or chosen[i].text is distinct from rejected[i].text)) - 1,
    least(len(chosen), len(rejected))) as integer) as n from p),
s as (select conv_id, n, chosen[1:n] as prompt, chosen[n + 1:] as c, rejected[n + 1:] as r from n)
select conv_id, n as prompt_turns, {_sql_text('prompt')} as prompt,
  {_sql_text('c')} as chosen_text, {_sql_mask('c')} as chosen_mask,
  {_sql_text('r')} as rejected_text, {_sql_mask('r')} as rejected_mask
from s
"""

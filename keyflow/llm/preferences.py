"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation is rendered once as the
prompt, what follows in each as a pair of completions with loss masks.

A turn is rendered as ``<|role|>``, a line end, its text, ``<|end|>`` and a line end. A mask is the runs of a completion's
code points as length:flag; the text and end of assistant turns have flag 1, all else 0. Conversations 2k and 2k + 1
are a pair, chosen first, with one shuffle by pair; a group is two conversations, whatever texts they share.

``<|`` inside a role or text is written ``<||``, so no text can end its turn or begin another; reading it back undoes that.

The query's pairs branch off a common start, as answers to one question do: the rejected side is the chosen one's first h
turns (h = unsigned crc32 of the decimal pair_id, modulo 4) and then its own turns after its first h (``branched``).

A missing role is ``unknown``, a missing text empty; turns are in order of (turn, role, text). Repeated rows are turns
of their own. A conversation without its partner has an empty other side and no common prefix; rows without a conv_id
belong to none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import table

END, HEADS = "<|end|>\n", 4


def _text(turns: str) -> str:
    return f"array_join(transform({turns}, t -> concat('<|', t.role, '|>\\n', t.text, '<|end|>\\n')), '')"


def _mask(turns: str) -> str:
    return f"array_join(transform({turns}, t -> concat(length(t.role) + 5, ':0,', length(t.text) + {len(END)}, ':', if(t.role = 'assistant', 1, 0))), ',')"


def escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def pairs(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as pair_id, chosen and rejected, arrays of (turn, role, text) in order."""
    rows = conversations.where("conv_id is not null").select(
        F.expr("conv_id - pmod(conv_id, 2)").alias("pair_id"),
        F.pmod("conv_id", F.lit(2)).alias("side"),
        F.struct("turn", escaped(F.coalesce("role", F.lit("unknown"))).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text")).alias("t"),
    )
    return rows.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.when(F.col("side") == 0, F.col("t")))).alias("chosen"), F.array_sort(F.collect_list(F.when(F.col("side") == 1, F.col("t")))).alias("rejected"))


def formatted(both: DataFrame) -> DataFrame:
    """Rows of pairs() with n_prompt_turns, prompt, and text and mask of both completions."""
    shorter = "least(size(chosen), size(rejected))"
    differs = "get(chosen, i).role <> get(rejected, i).role or get(chosen, i).text <> get(rejected, i).text"
    common = f"if({shorter} = 0, 0, coalesce(get(filter(sequence(0, {shorter} - 1), i -> {differs}), 0), {shorter}))"
    rows = both.withColumn("n_prompt_turns", F.expr(common))
    rest = {side: f"slice({side}, n_prompt_turns + 1, greatest(size({side}) - n_prompt_turns, 0))" for side in ("chosen", "rejected")}
    return rows.select(
        "pair_id",
        F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        F.expr(_text("slice(chosen, 1, n_prompt_turns)")).alias("prompt"),
        *[F.expr(_text(r)).alias(f"{side}_text") for side, r in rest.items()],
        *[F.expr(_mask(r)).alias(f"{side}_mask") for side, r in rest.items()],
    )


def branched(both: DataFrame) -> DataFrame:
    """Rows of pairs() in which rejected starts with the first h turns of chosen, in place of its own first h."""
    h = F.pmod(F.crc32(F.col("pair_id").cast("string")), F.lit(HEADS)).cast("int")
    return both.withColumn("__h", h).withColumn("rejected", F.expr("concat(slice(chosen, 1, __h), slice(rejected, __h + 1, greatest(size(rejected) - __h, 0)))")).drop("__h")


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(branched(pairs(table(spark, sf_dir, "conversations"))))


_SIDE = "coalesce(list({{'role': role, 'text': text}} order by turn nulls first, role, text) filter (where abs(conv_id % 2) = {n}), [])"
_BYTE = "list_reduce(range(8), lambda z, k: xor(z >> 1, 3988292384 * (z & 1)), xor(a, b))"
_CRC = f"xor(list_reduce(list_transform(string_split(pair_id::varchar, ''), lambda x: ascii(x)::bigint), lambda a, b: {_BYTE}, 4294967295), 4294967295)"
ORACLE = f"""
with t as (select conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '<||') as role, replace(coalesce(text, ''), '<|', '<||') as text from conversations where conv_id is not null),
q as (select conv_id - abs(conv_id % 2) as pair_id, {_SIDE.format(n=0)} as c, {_SIDE.format(n=1)} as own from t group by all),
p as (select pair_id, c, list_concat(c[1:h], own[h + 1:]) as r from (select *, {_CRC} % {HEADS} as h from q)),
n as (select *, coalesce(list_position(list_transform(range(1, least(len(c), len(r)) + 1), lambda i: c[i] is distinct from r[i]), true) - 1, least(len(c), len(r))) as n from p)
select pair_id, n::bigint as n_prompt_turns, """ + ", ".join(
    f"array_to_string(list_transform({part}, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') as {name}"
    for part, name in (("c[1:n]", "prompt"), ("c[n + 1:]", "chosen_text"), ("r[n + 1:]", "rejected_text"))
) + ", " + ", ".join(
    f"array_to_string(list_transform({part}, lambda x: (length(x.role) + 5) || ':0,' || (length(x.text) + {len(END)}) || ':' || (case when x.role = 'assistant' then 1 else 0 end)), ',') as {name}"
    for part, name in (("c[n + 1:]", "chosen_mask"), ("r[n + 1:]", "rejected_mask"))
) + " from n"
QUERIES = {"op6_preferences": op6_preferences}
ORACLES = {"op6_preferences": ORACLE}

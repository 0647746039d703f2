"""Preference pairs as text: the common turns once as prompt, then two completions with their masks.

A turn is rendered ``<|role|>`` newline text ``<|end|>`` newline; texts are
kept as they are.  The prompt is the longest common prefix of turns of both
conversations (equal role and text).  Each completion comes with the spans
``start-end`` (code points, end excluded) that a loss covers: the text and end
mark of the assistant's turns.  Everything else is masked.

Turns stand in the order of turn, role and text.  Null role and text count as
empty; a conversation missing on one side has no turns there; equal
conversations give two empty completions.  Turns that repeat stand each.  Rows
with a null pair key are left out, as they belong to no pair.  Only the columns
named are read; an empty table gives no rows.
"""

from __future__ import annotations

from evimap.llm.components import settle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key`` and its turns as array<struct<turn, role, text>> in order."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def rendered(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("<|end|>\n"))


def joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def spans(turns: Column) -> Column:
    """Spans of the assistant's turns in the rendered text of ``turns``; one pass with the place reached so far."""
    start = F.expr("named_struct('at', 0, 'found', cast(array() as array<string>))")

    def step(state: Column, x: Column) -> Column:
        size = F.length(rendered(x))
        own = F.concat_ws("-", (state["at"] + F.length(x["role"]) + 5).cast("string"), (state["at"] + size - 1).cast("string"))
        found = F.when(x["role"] == ASSISTANT, F.array_append(state["found"], own)).otherwise(state["found"])
        return F.struct((state["at"] + size).alias("at"), found.alias("found"))

    return F.array_join(F.aggregate(turns, start, step)["found"], ",")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key``, n_prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans of each pair (both sides from ``conversations``)."""
    none = F.expr("cast(array() as array<struct<turn:bigint, role:string, text:string>>)")
    both = chosen.withColumnRenamed("turns", "c").join(rejected.withColumnRenamed("turns", "r"), key, "full")
    both = both.select(key, F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    same = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    both = both.withColumn("n", F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size("c")).cast("int"))
    tail = lambda x: F.slice(x, F.col("n") + 1, F.greatest(F.size(x) - F.col("n"), F.lit(0)))
    return both.select(
        key, F.col("n").alias("n_prompt_turns"), joined(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        joined(tail("c")).alias("chosen"), spans(tail("c")).alias("chosen_spans"), joined(tail("r")).alias("rejected"), spans(tail("r")).alias("rejected_spans"),
    )


def swapped_answers(turns: DataFrame, key: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Pairs made from conversations: in the rejected one, the last answer is that of the next conversation that has one.

    Next is by ``key``, of any type that sorts; the last takes the first's, and
    the only answer of a table gives way to an empty one.  Answers are sorted
    over range partitions; only the first of each partition crosses to the one before.
    """
    chosen = conversations(turns, key)
    back = F.array_position(F.reverse(F.transform("turns", lambda x: x["role"])), ASSISTANT)
    at = chosen.withColumn("at", F.when(back > 0, F.size("turns") - back).cast("int"))
    own = settle(at.where("at is not null").select(F.col(key).alias("k"), F.expr("turns[at].text").alias("text")).sort("k").withColumn("part", F.spark_partition_id()))
    heads = own.groupBy("part").agg(F.min(F.struct("k", "text")).alias("head"), F.count("*").alias("n"))
    parts = Window.orderBy("part")  # one row for each partition of the sort
    whole = Window.partitionBy()
    heads = heads.select("part", F.coalesce(F.lead("head.text").over(parts), F.first("head.text").over(parts)).alias("after"), F.sum("n").over(whole).alias("all"))
    near = Window.partitionBy("part").orderBy("k")
    answers = own.join(heads, "part").select(F.col("k").alias(key), F.when(F.col("all") > 1, F.coalesce(F.lead("text").over(near), "after")).otherwise("").alias("other"))
    swap = F.transform("turns", lambda x, i: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), F.when(i == F.col("at"), F.coalesce("other", F.lit(""))).otherwise(x["text"]).alias("text")))
    return chosen, at.join(answers, key, "left").select(key, swap.alias("turns"))


#: The same query for the table ``conversations``.
PAIRS_SQL = """
with t as (select conv_id, row_number() over (partition by conv_id order by turn, role, text) i, role, text
           from (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations where conv_id is not null)),
last as (select conv_id, max(i) i from t where role = 'assistant' group by conv_id),
answer as (select conv_id, case when count(*) over () = 1 then '' else coalesce(lead(text) over (order by conv_id), first_value(text) over (order by conv_id)) end text
           from (select t.conv_id, t.text from t join last using (conv_id, i))),
sides as (select t.conv_id, t.i, t.role, t.text c, case when last.i is not null then coalesce(answer.text, '') else t.text end r
         from t left join last on last.conv_id = t.conv_id and last.i = t.i left join answer on answer.conv_id = t.conv_id),
cut as (select conv_id, coalesce(min(i) filter (c <> r), max(i) + 1) - 1 n from sides group by conv_id),
parts as (select conv_id, i, n, role, '<|' || role || '|>' || chr(10) || c || '<|end|>' || chr(10) c, '<|' || role || '|>' || chr(10) || r || '<|end|>' || chr(10) r from sides join cut using (conv_id)),
placed as (select *, coalesce(sum(length(c)) filter (i > n) over w, 0) pc, coalesce(sum(length(r)) filter (i > n) over w, 0) pr
           from parts window w as (partition by conv_id order by i rows between unbounded preceding and 1 preceding))
select conv_id, cast(any_value(n) as int) n_prompt_turns, coalesce(string_agg(c, '' order by i) filter (i <= n), '') prompt,
  coalesce(string_agg(c, '' order by i) filter (i > n), '') chosen,
  coalesce(string_agg(cast(pc + length(role) + 5 as varchar) || '-' || cast(pc + length(c) - 1 as varchar), ',' order by i) filter (i > n and role = 'assistant'), '') chosen_spans,
  coalesce(string_agg(r, '' order by i) filter (i > n), '') rejected,
  coalesce(string_agg(cast(pr + length(role) + 5 as varchar) || '-' || cast(pr + length(r) - 1 as varchar), ',' order by i) filter (i > n and role = 'assistant'), '') rejected_spans
from placed group by conv_id
"""

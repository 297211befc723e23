"""Preference formatting: shared prompt once, then the two completions with their loss masks.

Conversations ``2k`` and ``2k + 1`` are the chosen and the rejected side of pair ``k``.
Turns with equal number, role and text from the first one on are the prompt; everything
from the first difference on is the completion of its side.  Column expressions only.

The given conversations carry no sides and, on sf0.1, none of the 500 pairs shares its first turn; prefixes are tested on
planted pairs, against the SQL twin too.

Cases: rows without a conversation id belong to no pair and are left out; a null turn
counts as turn -1, a null role or text as empty; repeated rows count once; several
different rows of one turn stand in order of role and text; a pair with one side only
is kept with status ``unpaired``, a pair without any difference with status
``identical``.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns in one output row.  Longer pairs continue in rows with a higher ``part``.
TURNS_PER_PART = 64

# The turn template.
TURN_OPEN = "<|turn|>"
TURN_TEXT = "\n"
TURN_CLOSE = "<|end|>\n"
TRAINED_ROLE = "assistant"


def _head(role: Column) -> Column:
    return F.concat(F.lit(TURN_OPEN), role, F.lit(TURN_TEXT))


def _tail(turn: Column) -> Column:
    """What follows the head; in a trained turn this is what the loss covers."""
    return F.concat(turn["text"], F.lit(TURN_CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_head(t["role"]), _tail(t))), ""
    )


def _mask(turns: Column) -> Column:
    """[start, end) character spans of the rendered text that the loss covers."""
    span = "array<struct<start:int,end:int>>"

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.char_length(_head(turn["role"]))
        end = start + F.char_length(_tail(turn))
        grown = F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct(
            end.alias("at"),
            F.when(turn["role"] == TRAINED_ROLE, grown).otherwise(state["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans"))
    return F.aggregate(turns, start, step, lambda s: s["spans"])


def preference_pairs(conversations: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """One row per pair (and part, in very long pairs): prompt, completions, masks, status.

    Turns are compared one by one after grouping by (pair, turn), so a conversation of any
    length is never gathered to find its common prefix.
    """
    side = F.pmod(F.col("conv_id"), F.lit(2))
    message = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            F.floor((F.col("conv_id") - side) / 2).cast("long").alias("pair_id"),
            F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long")).alias("turn"),
            side.alias("side"),
            message.alias("message"),
        )
        .groupBy("pair_id", "turn")
        .agg(
            F.array_sort(F.collect_set(F.when(F.col("side") == 0, F.col("message")))).alias("a"),
            F.array_sort(F.collect_set(F.when(F.col("side") == 1, F.col("message")))).alias("b"),
        )
    )
    pairs = turns.groupBy("pair_id").agg(
        F.min(F.when(F.col("a") != F.col("b"), F.col("turn"))).alias("split"),
        F.max(F.size("a") > 0).alias("has_a"),
        F.max(F.size("b") > 0).alias("has_b"),
    )
    shared = F.col("split").isNull() | (F.col("turn") < F.col("split"))

    def section(name: str, turn: Column) -> Column:
        placed = F.array_sort(F.collect_list(F.when(turn, F.struct("turn", F.col(name).alias("m")))))
        return F.flatten(F.transform(placed, lambda x: x["m"]))

    parts = (
        turns.join(pairs, "pair_id")
        .groupBy("pair_id", F.floor((F.col("turn") + 1) / turns_per_part).cast("int").alias("part"))
        .agg(
            section("a", shared).alias("p"),
            section("a", ~shared).alias("c"),
            section("b", ~shared).alias("r"),
            F.max(F.when(~F.col("has_a") | ~F.col("has_b"), "unpaired").when(F.col("split").isNull(), "identical").otherwise("pair")).alias("status"),
        )
    )
    return parts.select(
        "pair_id",
        "part",
        "status",
        F.size("p").alias("prompt_turns"),
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _mask(F.col("c")).alias("chosen_mask"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("r")).alias("rejected_mask"),
    )


def digest(pairs: DataFrame) -> DataFrame:
    """Flat columns of ``preference_pairs``: masks as text, so that every engine compares them alike."""

    def flat(mask: str) -> Column:
        return F.array_join(F.transform(F.col(mask), lambda s: F.concat_ws("-", s["start"], s["end"])), ",")

    return pairs.withColumn("chosen_mask", flat("chosen_mask")).withColumn("rejected_mask", flat("rejected_mask"))


def oracle_sql(turns_per_part: int = TURNS_PER_PART) -> str:
    head = f"'{TURN_OPEN}' || m.role || chr(10)"
    tail = f"m.text || '{TURN_CLOSE.strip()}' || chr(10)"

    def rendered(x: str) -> str:
        return f"coalesce(array_to_string(list_transform({x}, lambda m: {head} || {tail}), ''), '')"

    def mask(x: str) -> str:
        done = (
            f"list_sum(list_transform(list_slice({x}, 1, i), lambda m: length({head} || {tail})))::int"
        )
        return (
            f"coalesce(array_to_string(list_transform(list_filter(range(1, len({x}) + 1), "
            f"lambda i: {x}[i].role = '{TRAINED_ROLE}'), "
            f"lambda i: ({done} - length({x}[i].text || '{TURN_CLOSE.strip()}' || chr(10)))::varchar || '-' || ({done})::varchar), ','), '')"
        )

    return f"""
with turns as (
  select (conv_id - (conv_id % 2 + 2) % 2) // 2 as pair_id, coalesce(turn, -1) as turn,
    list_sort(coalesce(list(distinct {{'role': coalesce(role, ''), 'text': coalesce(text, '')}}) filter ((conv_id % 2 + 2) % 2 = 0), [])) as a,
    list_sort(coalesce(list(distinct {{'role': coalesce(role, ''), 'text': coalesce(text, '')}}) filter ((conv_id % 2 + 2) % 2 = 1), [])) as b
  from conversations where conv_id is not null group by all
), pairs as (
  select pair_id, min(turn) filter (a <> b) as split, max(len(a)) as na, max(len(b)) as nb from turns group by pair_id
), parts as (
  select pair_id, floor((turn + 1) / {turns_per_part}e0)::int as part,
    coalesce(flatten(list(a order by turn) filter (split is null or turn < split)), []) as p,
    coalesce(flatten(list(a order by turn) filter (turn >= split)), []) as c,
    coalesce(flatten(list(b order by turn) filter (turn >= split)), []) as r,
    any_value(case when na = 0 or nb = 0 then 'unpaired' when split is null then 'identical' else 'pair' end) as status
  from turns join pairs using (pair_id) group by all
)
select pair_id, part, status, len(p)::int as prompt_turns, {rendered('p')} as prompt,
  {rendered('c')} as chosen, {mask('c')} as chosen_mask,
  {rendered('r')} as rejected, {mask('r')} as rejected_mask
from parts
"""

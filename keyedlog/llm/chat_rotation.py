"""Dialogues from every participant's perspective, in DataFrame functions only.

For each participant of a conversation (each role but ``system``), the dialogue is rendered with
that speaker as the assistant, everybody else as a user with a name, and system messages as they
are. A rendered turn is one row with its place in the whole dialogue, so a conversation of any
length stays in rows of bounded size; the dialogue is its segments in order. The loss mask covers
what the assistant says, up to and including its end marker.

Places are running sums. They are formed within chunks of turns, over the chunks of a block of
turns, and over blocks, so a conversation with a third of all rows is not the work of one task.

Turns go by turn (null first), then role, then text; messages that repeat turn, role and text of a
conversation count once. A null text is empty. A null role speaks as the user ``unknown`` and is no
participant. Rows without conv_id take no part, nor do conversations without participants. Marks
of the format within texts and names are taken apart, so no text can end its turn. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>"
MARK, APART = "<|", "< |"
SYSTEM = "system"
NOBODY = "unknown"

CHUNK = 256
BLOCK = 65536


def _harmless(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(APART))


def rotate(conversations: DataFrame) -> DataFrame:
    """(conv_id, speaker, place, turn, segment, start, end, mask_start, mask_end).

    ``start`` and ``end`` count characters of the rendered dialogue, the end exclusive. The mask is
    null for the turns of others.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.col("role").cast("string"), F.col("text").cast("string")).distinct()
    speakers = turns.where(F.col("role") != SYSTEM).select(
        "conv_id", F.col("role").alias("speaker")).distinct()
    rows = turns.join(speakers.hint("rebalance"), "conv_id")
    own = F.coalesce(F.col("role") == F.col("speaker"), F.lit(False))
    header = (
        F.when(F.col("role") == SYSTEM, F.lit(START + "system\n"))
        .when(own, F.lit(START + "assistant\n"))
        .otherwise(F.concat(F.lit(START + "user name="),
                            _harmless(F.coalesce("role", F.lit(NOBODY))), F.lit("\n")))
    )
    rows = rows.select(
        "conv_id", "speaker", "turn", "role", "text", own.alias("own"), header.alias("header"),
        F.concat(_harmless(F.col("text")), F.lit(END)).alias("said"),
        F.floor(F.coalesce("turn", F.lit(-1)) / CHUNK).alias("chunk"),
        F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK).alias("block"),
    ).withColumn("size", F.length("header") + F.length("said") + 1)

    dialogue = ["conv_id", "speaker"]

    def before(keys: list, order: list) -> dict[str, Column]:
        """Sums of the rows ahead within the keys."""
        ahead = Window.partitionBy(keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return {"size": F.coalesce(F.sum("size").over(ahead), F.lit(0)),
                "turns": F.coalesce(F.sum("turns").over(ahead), F.lit(0))}

    def ahead_of(frame: DataFrame, keys: list, order: list, name: str) -> DataFrame:
        sums = before(keys, order)
        return frame.select("*", sums["size"].alias(f"size_{name}"),
                            sums["turns"].alias(f"turns_{name}"))

    in_order = [F.asc_nulls_first(c) for c in ("turn", "role", "text")]
    rows = ahead_of(rows.withColumn("turns", F.lit(1)), [*dialogue, "block", "chunk"], in_order,
                    "chunk")
    totals = rows.groupBy(*dialogue, "block", "chunk").agg(
        F.sum("size").alias("size"), F.sum("turns").alias("turns"))
    chunks = ahead_of(totals, [*dialogue, "block"], ["chunk"], "block").drop("size", "turns")
    block_totals = totals.groupBy(*dialogue, "block").agg(
        F.sum("size").alias("size"), F.sum("turns").alias("turns"))
    blocks = ahead_of(block_totals, dialogue, ["block"], "all").drop("size", "turns")
    placed = rows.join(chunks, [*dialogue, "block", "chunk"]).join(blocks, [*dialogue, "block"])
    start = F.col("size_chunk") + F.col("size_block") + F.col("size_all")
    place = F.col("turns_chunk") + F.col("turns_block") + F.col("turns_all")
    return placed.select(
        "conv_id", "speaker", (place + 1).cast("bigint").alias("place"), "turn",
        F.concat("header", "said", F.lit("\n")).alias("segment"),
        start.cast("bigint").alias("start"), (start + F.col("size")).cast("bigint").alias("end"),
        F.when(F.col("own"), start + F.length("header")).cast("bigint").alias("mask_start"),
        F.when(F.col("own"), start + F.col("size") - 1).cast("bigint").alias("mask_end"),
    )


SQL = f"""
with turns as (
  select distinct conv_id, turn, role, text from conversations where conv_id is not null),
speakers as (
  select distinct conv_id, role as speaker from turns where role <> '{SYSTEM}'),
parts as (
  select conv_id, speaker, turn, role, text, coalesce(role = speaker, false) as own,
    case when role = '{SYSTEM}' then '{START}system' || chr(10)
      when role = speaker then '{START}assistant' || chr(10)
      else '{START}user name=' || replace(coalesce(role, '{NOBODY}'), '{MARK}', '{APART}') || chr(10)
      end as header,
    replace(coalesce(text, ''), '{MARK}', '{APART}') || '{END}' as said
  from turns join speakers using (conv_id)),
sized as (select *, length(header) + length(said) + 1 as size from parts),
placed as (
  select *, row_number() over w as place, sum(size) over w as stop from sized
  window w as (partition by conv_id, speaker order by turn nulls first, role nulls first,
    text nulls first rows between unbounded preceding and current row))
select conv_id, speaker, cast(place as bigint) as place, turn,
  header || said || chr(10) as segment, cast(stop - size as bigint) as start,
  cast(stop as bigint) as "end",
  cast(case when own then stop - size + length(header) end as bigint) as mask_start,
  cast(case when own then stop - 1 end as bigint) as mask_end
from placed
"""

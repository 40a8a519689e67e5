"""Perspectives of a dialogue, in SQL functions only.

For every participant of a dialogue the whole dialogue is rendered with that speaker as the assistant, all others as named users and system turns as
they are. The loss mask is the characters of the assistant's turns, end mark included.

A dialogue is cut into blocks of BLOCK turns, one row for each participant and block, so no task holds a whole dialogue however
long it is. Turns get their place in the dialogue by a range partition of all turns: each range numbers its own turns, and the counts of the ranges
before are added. Only blocks are grouped, and they meet the participants by a join that the runtime splits.

Defined results: turns are ordered by turn, role, text with nulls first; a repeated row counts once; a null role is the speaker `unknown`; a
null text is an empty turn; a row without conv_id is a dialogue of its own; a dialogue of system turns only has no participant and no row;
an empty table gives no rows. Further columns of the input are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from floegrid.llm.tables import cut, partitions

BLOCK = 256
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>\n"


def placed_turns(turns: DataFrame) -> DataFrame:
    """dialogue, conv_id, place (from 0), name and text of every different row."""
    row = turns.select("conv_id", "turn", "role", "text").distinct()
    alone = F.concat(F.lit("row "), F.hex(F.xxhash64("turn", "role", "text")), F.lit(" "),
                     F.hex(F.xxhash64(F.lit(1), "text", "role", "turn")))
    named = row.withColumn("dialogue", F.coalesce(F.concat(F.lit("conv "), F.col("conv_id").cast("string")), alone))
    order = ["dialogue", "turn", "role", "text"]
    # The range of a row must not change when it is read again, so the ranges are written.
    ranged = cut(named.repartitionByRange(partitions(turns.sparkSession), *order).withColumn("_part", F.spark_partition_id()))
    own = Window.partitionBy("dialogue", "_part").orderBy("turn", "role", "text")
    local = ranged.withColumn("_i", F.row_number().over(own) - 1)
    sizes = ranged.groupBy("dialogue", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("dialogue").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("dialogue", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return local.join(starts, ["dialogue", "_part"]).select(
        "dialogue", "conv_id", (F.col("_start") + F.col("_i")).alias("place"), F.coalesce("role", F.lit(UNKNOWN)).alias("name"),
        F.coalesce("text", F.lit("")).alias("text"))


def perspectives(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, dialogue, speaker, block, n_turns, start_char, rendered, masks and n_masked.

    start_char is the place of the block in the whole rendered dialogue; masks lists `first-end` places, end excluded, of
    the assistant's characters in the whole dialogue.
    """
    placed = placed_turns(turns)
    # `conv_id` is one value in a dialogue, so grouping by it changes nothing. Written, as lengths and texts are read apart.
    blocks = cut(placed.groupBy("dialogue", "conv_id", F.floor(F.col("place") / block).alias("block"))
                 .agg(F.array_sort(F.collect_list(F.struct("place", "name", "text"))).alias("t")))
    head = f"""CASE WHEN x.name = '{SYSTEM}' THEN '<|system|>\\n' WHEN x.name = speaker THEN '<|assistant|>\\n'
               ELSE concat('<|user name=', x.name, '|>\\n') END"""
    pieces = F.expr(f"transform(t, x -> struct({head} AS head, concat(x.text, '{END}') AS body, x.name = speaker AS own))")
    rendered = F.expr("array_join(transform(p, x -> concat(x.head, x.body)), '')")
    # Lengths follow without the texts: every block's as if all its turns were users', less what a speaker's own turns save.
    plain = f"""aggregate(t, 0L, (n, x) -> n + length(x.text) + {len(END)} + if(x.name = '{SYSTEM}', {len(SYSTEM) + 5}, length(x.name) + 15))"""
    whole = blocks.select("dialogue", "block", F.expr(plain).alias("_n"))
    own = (blocks.select("dialogue", "block", F.explode(F.transform("t", lambda x: x["name"])).alias("speaker")).where(F.col("speaker") != SYSTEM)
           .groupBy("dialogue", "block", "speaker").agg(F.count(F.lit(1)).alias("_own")))
    lengths = (whole.join(own.select("dialogue", "speaker").distinct(), "dialogue").join(own, ["dialogue", "block", "speaker"], "left")
               .withColumn("_n", F.col("_n") - F.coalesce("_own", F.lit(0)) * (F.length("speaker") + 1)))
    before = Window.partitionBy("dialogue", "speaker").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("dialogue", "block", "speaker", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("start_char"))
    # Texts move once, before they are turned for each speaker.
    keys = ["dialogue", "speaker", "block"]
    counted = (blocks.join(starts, ["dialogue", "block"]).withColumn("p", pieces)
               .select("conv_id", *keys, F.size("p").cast("long").alias("n_turns"), "p", rendered.alias("rendered"), "start_char"))
    spans = F.expr("""aggregate(p, struct(start_char AS at, cast(array() AS array<string>) AS spans, 0L AS n), (s, x) -> struct(
        s.at + length(x.head) + length(x.body) AS at,
        if(x.own, array_append(s.spans, concat(string(s.at + length(x.head)), '-',
                                               string(s.at + length(x.head) + length(x.body)))), s.spans) AS spans,
        s.n + if(x.own, length(x.body), 0) AS n), s -> struct(array_join(s.spans, ',') AS masks, s.n AS n))""")
    return counted.withColumn("m", spans).select(
        "conv_id", "dialogue", "speaker", "block", "n_turns", "start_char", "rendered", F.col("m.masks").alias("masks"),
        F.col("m.n").alias("n_masked"))

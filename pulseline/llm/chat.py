"""Chat formatting by perspective rotation, in DataFrame operations only.

A dialogue of several parties is rendered once for every participant: that
speaker's turns become the assistant's, all other speakers are named users,
system turns stay what they are, and the loss mask covers the assistant's
words.  Dialogues are rendered in blocks of consecutive turns, so a very long
one is spread over many rows and tasks.  A block that has more messages than
turns (null turns, or many messages of one number) is cut by the rank of its
messages into parts of as many; the blocks and parts of a rendering, one after
the other, are the whole of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import table
from pulseline.operators.running import chunked_position
from pulseline.session import materialize

BLOCK_TURNS = 64
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>\n"


def _safe(text: Column) -> Column:
    """No text can hold a marker."""
    return F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))


def _parts(m: DataFrame, most: int) -> DataFrame:
    """``m`` with the part of its block that each message is in: its rank in
    the block's order, divided by ``most``.

    Only blocks with more than ``most`` messages are ranked.  Their messages
    are dealt by ranges of the order, so that one block spreads over tasks;
    the range is the chunk of the rank.
    """
    block, order = ["conv_id", "block"], ["turn", "role", "text"]
    m = materialize(m, "messages")
    large = materialize(m.groupBy(*block).count().where(F.col("count") > most).select(
        F.col("conv_id").alias("of_id"), F.col("block").alias("of_block")), "large")
    if large.isEmpty():
        return m.withColumn("part", F.lit(0).cast("long"))
    same = F.col("conv_id").eqNullSafe(F.col("of_id")) & (F.col("block") == F.col("of_block"))
    hot = m.join(large, same, "left_semi")
    # keys without null, since chunks are joined by them
    hot = hot.select("*", F.col("conv_id").isNull().alias("no_id"),
                     F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"))
    keys = ["no_id", "id", "block"]
    hot = materialize(hot.repartitionByRange(*keys, *(F.col(c).asc_nulls_first() for c in order))
                      .withColumn("chunk", F.spark_partition_id()), "hot")
    ranked = chunked_position(hot, keys, "chunk", order, "role").select(
        *m.columns, F.floor((F.col("pos") - 1) / most).cast("long").alias("part"))
    return m.join(large, same, "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(ranked)


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text",
           block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, speaker, block, part, n_messages, n_own, text, mask): one row
    for each participant and block of turns; mask has the (start, end) spans of
    the speaker's own words in the row's text, end marker included.

    Turns are in order of number, then role, then text; block b has the turns
    from b * ``block_turns`` on.  Of a block with more than ``block_turns``
    messages, part p has those from rank p * ``block_turns`` on; others have
    part 0 only.  A repeated row (all four columns equal) is
    one message; different messages with one turn number all stay.  A null
    text is empty, a null role is the speaker named by the empty string, null
    turns come first, in block -1, and null conversations are one
    conversation.  A conversation of system turns only has no participant and
    no row; an empty table gives none.  Other columns are not read.
    """
    m = turns.select(
        turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
        F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("role"),
        _safe(turns[text_col]).alias("text"),
        F.coalesce(F.floor(turns[turn_col] / block_turns), F.lit(-1)).cast("long").alias("block"))
    m = _parts(m.distinct(), block_turns)
    blocks = m.groupBy("conv_id", "block", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    speakers = m.where(F.col("role") != SYSTEM).select(
        F.col("conv_id").alias("of_id"), F.col("role").alias("speaker")).distinct()
    rows = blocks.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_id"))).drop("of_id")

    def head(x: Column) -> Column:
        return F.when(x["role"] == F.col("speaker"), f"{START}assistant\n").when(
            x["role"] == SYSTEM, f"{START}{SYSTEM}\n").otherwise(
            F.concat(F.lit(f"{START}user name="), _safe(x["role"]), F.lit("\n")))

    rows = rows.withColumn("parts", F.transform("messages", lambda x: F.struct(
        F.concat(head(x), x["text"], F.lit(END)).alias("text"),
        F.length(head(x)).alias("head"), (x["role"] == F.col("speaker")).alias("own"))))
    # spans by a running length over the block's parts
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def grow(a: Column, p: Column) -> Column:
        end = a["at"] + F.length(p["text"])
        return F.struct(end.alias("at"), F.when(p["own"], F.array_append(
            a["spans"], F.struct((a["at"] + p["head"]).alias("start"), end.alias("end")))
            ).otherwise(a["spans"]).alias("spans"))

    return rows.select(
        "conv_id", "speaker", "block", "part", F.size("messages").cast("long").alias("n_messages"),
        F.size(F.filter("parts", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        F.aggregate("parts", empty, grow)["spans"].alias("mask"))


def op9_chat_rotation(spark, sf_dir):
    return rotate(table(spark, sf_dir, "conversations")).select(
        "conv_id", "speaker", "block", "part", "n_messages", "n_own",
        F.length("text").cast("long").alias("n_chars"),
        F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
        .alias("mask"),
        F.sha2("text", 256).alias("text_sha256"))


OP9_SQL = f"""
WITH m AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text,
         coalesce(CAST(floor(turn / {BLOCK_TURNS}) AS BIGINT), -1) AS block
  FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> '{SYSTEM}'),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id, block ORDER BY turn NULLS FIRST, role, text) - 1)
            // {BLOCK_TURNS} AS part
  FROM m),
p AS (
  SELECT m.*, s.speaker, m.role = s.speaker AS own,
         '{START}' || CASE WHEN m.role = s.speaker THEN 'assistant' WHEN m.role = '{SYSTEM}'
           THEN '{SYSTEM}' ELSE 'user name=' || replace(m.role, '<|', '< |') END || chr(10) AS head
  FROM r m JOIN s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
q AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS shown,
         sum(length(head) + length(text) + 11) OVER (
           PARTITION BY conv_id, speaker, block, part ORDER BY turn NULLS FIRST, role, text
           ROWS UNBOUNDED PRECEDING) AS stop
  FROM p)
SELECT conv_id, speaker, block, part, count(*) AS n_messages,
       CAST(sum(CASE WHEN own THEN 1 ELSE 0 END) AS BIGINT) AS n_own,
       CAST(max(stop) AS BIGINT) AS n_chars,
       coalesce(string_agg(CASE WHEN own THEN (stop - length(text) - 11)::VARCHAR || ':' || stop::VARCHAR END,
                  ',' ORDER BY turn NULLS FIRST, role, text), '') AS mask,
       sha256(string_agg(shown, '' ORDER BY turn NULLS FIRST, role, text)) AS text_sha256
FROM q GROUP BY conv_id, speaker, block, part
"""

"""Seeded cumulative word counts over text records.

Each text record (one stream line / one document) is split on single
spaces with the JVM ``String.split(" ")`` rule.  Counts start from a seed
(``hello`` and ``world`` at 1 by default); a seed word is reported only
once it occurs in the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pulseline.config import DEFAULT_WORD_SEED
from pulseline.functions.fields import space_tokens
from pulseline.operators.running import chunked_running, number_ranges

CHUNK, WORDS, SIZE = "_chunk", "_words", "_size"
SHORT_SEED = 10_000  # words of 1 KB at most: 10 MB


def tokenize(texts: DataFrame, text_col: str = "text", id_col: str = "doc_id", carry=(),
             lists: bool = False) -> DataFrame:
    """(id, pos, word) for every token; ``pos`` is 0-based within the text;
    ``carry`` names columns to keep beside.  With ``lists`` a row for each
    text instead: all its words in a list, and the text's size in bytes."""
    if lists:
        return texts.where(F.col(text_col).isNotNull()).select(
            F.col(id_col), *carry, space_tokens(F.col(text_col)).alias(WORDS),
            F.octet_length(text_col).cast("bigint").alias(SIZE))
    return texts.select(F.col(id_col), *carry, F.posexplode(space_tokens(F.col(text_col)))
                        .alias("pos", "word"))


def seed_frame(spark: SparkSession, seed=DEFAULT_WORD_SEED) -> DataFrame:
    return spark.createDataFrame(list(seed), "word STRING, seed_n BIGINT")


def with_seed(df: DataFrame, seed) -> DataFrame:
    """Attach ``seed_n``.  A seed given as a short Python list is broadcast;
    a longer one or a seed DataFrame (e.g. the totals of an earlier run, as
    large as the vocabulary) is joined normally and left to AQE's
    size-checked join choice."""
    spark = df.sparkSession
    if isinstance(seed, DataFrame):
        s = seed.select("word", F.col(seed.columns[1]).cast("bigint").alias("seed_n"))
        return df.join(s, "word", "left")
    s = seed_frame(spark, seed)
    return df.join(F.broadcast(s) if len(seed) <= SHORT_SEED else s, "word", "left")


def word_totals(tokens: DataFrame, seed=DEFAULT_WORD_SEED) -> DataFrame:
    """Final count per word (seed + occurrences); partial aggregation first."""
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return with_seed(counts, seed).select(
        "word", (F.col("n") + F.coalesce(F.col("seed_n"), F.lit(0))).alias("n"))


CHUNK_TEXTS = 64
CHUNK_BYTES = 4 << 20  # of texts in a chunk that is counted at once, on average
MOST_BYTES = 16 << 20  # chunks with more are counted by a sort


def texts_per_chunk(texts: DataFrame, text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> int:
    """How many texts have about ``chunk_bytes``."""
    mean = texts.agg(F.avg(F.octet_length(text_col))).first()[0]
    return max(1, int(chunk_bytes // max(1, mean or 1)))


def with_text_chunk(texts: DataFrame, id_col: str = "doc_id", texts_per_chunk: int = CHUNK_TEXTS) -> DataFrame:
    """Add consecutive ranges of ids with so many texts each (more where
    there would be over 2^20 ranges, as a word's chunk totals meet in one
    prefix-window task)."""
    return number_ranges(texts, id_col, CHUNK, texts_per_chunk)


def words_of_chunk(texts: pa.Table) -> pa.Table:
    """How often a chunk's texts have each of their words."""
    words = texts[WORDS].combine_chunks().flatten().value_counts()
    return pa.table({"word": words.field("values"), CHUNK: texts[CHUNK].take(pa.array(np.zeros(len(words), np.int64))),
                     "n": words.field("counts")})


def count_in_chunk(texts: pa.Table, before: pa.Table, id_col: str) -> pa.Table:
    """The tokens of a chunk's texts, each with its word's count so far:
    ``before`` the chunk, and in it in order of (id, pos)."""
    texts = texts.take(pc.sort_indices(texts, sort_keys=[(id_col, "ascending")], null_placement="at_start"))
    ids, lists = texts[id_col].combine_chunks(), texts[WORDS].combine_chunks()
    words, text = lists.flatten(), lists.value_parent_indices().to_numpy()
    lengths = lists.value_lengths().to_numpy()
    pos = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    distinct = ids.dictionary_encode(null_encoding="encode")
    if len(distinct.dictionary) < len(ids):  # texts with the same id take turns by position
        order = np.lexsort((pos, distinct.indices.to_numpy()[text]))
        words, text, pos = words.take(pa.array(order)), text[order], pos[order]
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy()
    counts = np.bincount(code, minlength=len(coded.dictionary))
    n = np.empty(len(words), np.int64)
    n[np.argsort(code, kind="stable")] = np.arange(1, len(words) + 1) - np.repeat(np.cumsum(counts) - counts, counts)
    known = before["before"].combine_chunks().take(
        pc.index_in(coded.dictionary, value_set=before["word"].combine_chunks()))
    n += known.fill_null(0).to_numpy()[code]
    return pa.table({id_col: ids.take(pa.array(text)), "pos": pa.array(pos, pa.int32()), "word": words, "n": n})


def _running_in_lists(texts: DataFrame, seed, id_col: str, most_bytes: int) -> DataFrame:
    """Texts meet their chunk, and words are not sorted: a task holds one
    chunk's texts and counts of words before it.  Chunks of over
    ``most_bytes`` (texts without an id, many with the same, or long ones) are
    exploded and sorted, as are tokens in rows."""
    # texts without an id come first
    texts = texts.withColumn(CHUNK, F.coalesce(F.col(CHUNK), F.lit(-1)))
    sizes = texts.groupBy(CHUNK).agg(F.sum(SIZE).alias(SIZE)).where(F.col(SIZE) > most_bytes)
    large = sizes.select(CHUNK).toArrow()  # 8 bytes a chunk
    table = F.broadcast(texts.sparkSession.createDataFrame(large)) if len(large) else None
    held = texts.join(table, CHUNK, "left_anti") if len(large) else texts
    # one exchange serves both passes over the texts
    held = held.select(id_col, CHUNK, WORDS).repartition(CHUNK)
    counts = held.groupBy(CHUNK).applyInArrow(words_of_chunk, f"word STRING, {CHUNK} BIGINT, n BIGINT")
    if len(large):
        rest = texts.join(table, CHUNK, "left_semi").select(id_col, CHUNK, F.posexplode(WORDS).alias("pos", "word"))
        counts = counts.union(rest.groupBy("word", CHUNK).agg(F.count(F.lit(1)).alias("n")))
    earlier = Window.partitionBy("word").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before = with_seed(counts.withColumn("before", F.sum("n").over(earlier)), seed).select(
        "word", CHUNK, (F.coalesce("before", F.lit(0)) + F.coalesce("seed_n", F.lit(0))).cast("bigint").alias(
            "before")).where(F.col("before") != 0)

    schema = StructType([texts.schema[id_col], StructField("pos", IntegerType()), StructField("word", StringType()),
                         StructField("n", LongType())])
    of_held = before.join(table, CHUNK, "left_anti") if len(large) else before
    of_held = of_held.select("word", F.col(CHUNK).alias("_of"), "before")
    out = held.groupBy(CHUNK).cogroup(of_held.groupBy("_of")).applyInArrow(
        lambda some, known: count_in_chunk(some, known, id_col), schema)
    if len(large):
        inside = Window.partitionBy("word", CHUNK).orderBy(F.col(id_col).asc_nulls_first(), "pos").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        run = rest.withColumn("n", F.count(F.lit(1)).over(inside)).join(
            before.join(table, CHUNK, "left_semi"), ["word", CHUNK], "left")
        out = out.union(run.select(id_col, "pos", "word", F.col("n") + F.coalesce("before", F.lit(0))))
    return out


def running_word_count(tokens: DataFrame, seed=DEFAULT_WORD_SEED, id_col: str = "doc_id",
                       most_bytes: int = MOST_BYTES) -> DataFrame:
    """Every token with its word's cumulative count so far, in (id, pos) order.

    ``tokens`` carry the chunk of their text (``with_text_chunk``), so a very
    frequent word is counted over many tasks (see operators.running): a chunk
    task holds the tokens of one word in one chunk's texts.  Tokens without a
    chunk are one.  Tokens in lists (``tokenize(lists=True)``) are counted a
    chunk at a time, which moves and sorts far less.
    """
    if CHUNK not in tokens.columns:
        tokens = tokens.withColumn(CHUNK, F.lit(0).cast("bigint"))
    if WORDS in tokens.columns:
        return _running_in_lists(tokens, seed, id_col, most_bytes)
    run = chunked_running(tokens, ["word"], CHUNK, [id_col, "pos"],
                          {"run_n": ("count", F.lit(1))}, totals_from_window=True)
    return with_seed(run, seed).select(
        id_col, "pos", "word",
        (F.col("run_n") + F.coalesce(F.col("seed_n"), F.lit(0))).cast("bigint").alias("n"))

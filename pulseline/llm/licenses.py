"""License scan by diagonal voting, in DataFrame operations only.

Every text gives its rolling word pairs.  A hash join (templates are a fixed
list, so they are broadcast) puts each pair at the template positions where it
occurs; a hit of text position d at template position t votes for the diagonal
d - t.  Votes are aggregated by (row, template, diagonal) as a bit mask of
template positions, neighbouring diagonals of one template are merged into
spans (an inserted or missing word shifts the diagonal), and a span counts if
enough of the template's pairs voted.  The join also compares the words
themselves, so a full mask is an exact occurrence of a phrase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import NON_WORD, ascii_lower, split_words, table

#: The contract's phrases.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Opening words of public license notices, at most 64 words each.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files": "mit",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license": "gpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under a creative commons attribution sharealike 4 0 international license":
        "cc-by-sa-4.0",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Pairs of these words alone occur in any English text and cast no vote.
FUNCTION_WORDS = frozenset("a and any are for in into is it of or that the this to with you".split())


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[tuple]:
    """(template, label, is_phrase, full mask, t, word, next word) per voting pair."""
    rows = []
    for k, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        words = text.split()
        pairs = [(t, a, b) for t, (a, b) in enumerate(zip(words, words[1:]))
                 if k < len(phrases) or not {a, b} <= FUNCTION_WORDS]
        if not pairs or pairs[-1][0] > 62:
            raise ValueError(f"a template needs 2 to 63 words: {text}")
        full = sum(1 << t for t, _, _ in pairs)
        rows += [(k, label, k < len(phrases), full, t, a, b) for t, a, b in pairs]
    return rows


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
                  coverage: float = 0.75, drift: int = 4, gap: int = 8) -> DataFrame:
    """One row per row of ``docs``.

    ``n_base``/``first_word``/``last_word``/``base_labels`` tell of the exact
    phrases; ``labels`` adds those of notices of which at least ``coverage`` of
    the voting pairs lie on diagonals at most ``drift`` apart, with at most
    ``gap`` words between their runs; ``score`` is the largest share of a
    template's pairs found in one span.

    Null, empty and word-less texts give zero counts, null positions, empty
    labels and score 0.  Repeated rows are scanned each by itself (a row
    number, not the id, keys the votes); an empty table gives no row.  Columns
    besides the two named are not read.
    """
    spark = docs.sparkSession
    rows = templates(phrases, notices)
    known = spark.createDataFrame(
        rows, "tmpl int, label string, is_phrase boolean, full long, t int, t1 string, t2 string"
    ).withColumn("h", F.xxhash64("t1", "t2"))
    words = docs.select(
        F.monotonically_increasing_id().alias("rid"), docs[id_col].alias("doc_id"),
        split_words(ascii_lower(docs[text_col].cast("string")), NON_WORD).alias("w"))
    pairs = words.select(
        "rid", "doc_id", F.size("w").cast("long").alias("n_words"),
        F.posexplode_outer(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b")))
        .alias("d", "pair"))
    pairs = pairs.select("rid", "doc_id", "n_words", "d", F.col("pair.a").alias("w1"),
                         F.col("pair.b").alias("w2"))
    hit = F.col("t1").eqNullSafe(F.col("w1")) & F.col("t2").eqNullSafe(F.col("w2"))
    hits = (
        pairs.withColumn("h", F.xxhash64("w1", "w2"))
        .join(F.broadcast(known), "h", "left")
        .withColumn("hit", F.col("tmpl").isNotNull() & hit)
        # the first pair of a row stays, so that rows without a hit stay too
        .where(F.col("hit") | F.coalesce(F.col("d"), F.lit(0)).eqNullSafe(F.lit(0)))
        .select("rid", "doc_id", "n_words", F.when(F.col("hit"), F.struct(
            "tmpl", "label", "is_phrase", "full", "t",
            (F.col("d") - F.col("t")).alias("diagonal"), "d")).alias("v"))
        .repartition("rid")
    )
    votes = (
        hits.select("rid", "doc_id", "n_words", "v.*")
        .groupBy("rid", "doc_id", "n_words", "tmpl", "label", "is_phrase", "full", "diagonal")
        .agg(F.bit_or(F.expr("shiftleft(1L, t)")).alias("mask"),
             F.min("d").alias("first"), F.max("d").alias("last"))
    )
    order = Window.partitionBy("rid", "tmpl").orderBy("first", "diagonal")
    apart = (F.col("first") > F.lag("last").over(order) + gap) | (
        F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > drift)
    exact = F.col("is_phrase") & (F.col("mask") == F.col("full"))
    spans = (
        votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(order))
        .groupBy("rid", "doc_id", "n_words", "tmpl", "label", "is_phrase", "full", "span")
        .agg(F.sum(F.when(exact, 1).otherwise(0)).alias("n_exact"),
             F.min(F.when(exact, F.col("diagonal"))).alias("from_word"),
             F.max(F.when(exact, F.col("diagonal"))).alias("to_word"),
             F.bit_or("mask").alias("mask"))
        .withColumn("share", F.bit_count("mask") / F.bit_count("full"))
    )
    base = F.col("n_exact") > 0
    more = ~F.col("is_phrase") & (F.col("share") >= coverage)
    return (
        spans.groupBy("rid", "doc_id", "n_words")
        .agg(F.sum("n_exact").cast("long").alias("n_base"),
             F.min("from_word").cast("long").alias("first_word"),
             F.max("to_word").cast("long").alias("last_word"),
             _joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
             _joined(F.collect_set(F.when(base | more, F.col("label")))).alias("labels"),
             F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
        .drop("rid")
    )


def op2_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))



def _oracle(coverage: float = 0.75, drift: int = 4, gap: int = 8) -> str:
    known = ", ".join(f"({k}, '{label}', {phrase}, {full}, {t}, '{a}', '{b}')"
                      for k, label, phrase, full, t, a, b in templates())
    return f"""
WITH known(tmpl, label, is_phrase, full_mask, t, t1, t2) AS (VALUES {known}),
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
    lambda x: x <> '') AS w
  FROM documents),
pair AS (
  SELECT doc_id, i - 1 AS d, w[i] AS w1, w[i + 1] AS w2
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w)),
vote AS (
  SELECT doc_id, tmpl, label, is_phrase, full_mask, d - t AS diagonal,
         bit_or(CAST(1 AS BIGINT) << t) AS mask, min(d) AS lo, max(d) AS hi
  FROM pair JOIN known ON w1 = t1 AND w2 = t2
  GROUP BY doc_id, tmpl, label, is_phrase, full_mask, d - t),
cut AS (
  SELECT *, CASE WHEN lo <= lag(hi) OVER o + {gap} AND abs(diagonal - lag(diagonal) OVER o) <= {drift}
                 THEN 0 ELSE 1 END AS fresh
  FROM vote WINDOW o AS (PARTITION BY doc_id, tmpl ORDER BY lo, diagonal)),
band AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, tmpl ORDER BY lo, diagonal ROWS UNBOUNDED PRECEDING) AS k
  FROM cut),
span AS (
  SELECT doc_id, label, is_phrase, count(*) FILTER (is_phrase AND mask = full_mask) AS n_exact,
         min(diagonal) FILTER (is_phrase AND mask = full_mask) AS lo,
         max(diagonal) FILTER (is_phrase AND mask = full_mask) AS hi,
         bit_count(bit_or(mask)) / bit_count(full_mask) AS share
  FROM band GROUP BY doc_id, tmpl, label, is_phrase, full_mask, k),
doc AS (
  SELECT doc_id, sum(n_exact) AS n_base, min(lo) AS first_word, max(hi) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (n_exact > 0) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label)
           FILTER (n_exact > 0 OR (NOT is_phrase AND share >= {coverage})) AS labels,
         max(share) AS score
  FROM span GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM w LEFT JOIN doc USING (doc_id)
"""


OP2_SQL = _oracle()

"""Line dedup by distinct-site spread, in DataFrame operations only.

A HyperLogLog sketch of the sites of each line hash is built and merged by
aggregation.  Lines whose estimate is near the threshold get an exact count
of their sites; the others are decided by the sketch, whose error is far
smaller than their distance from the threshold.  Lines on ``min_sites`` sites
or more are boilerplate: all but the first occurrence (smallest id, then line)
go, however much of a text that is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import SPACES, by_place, table
from pulseline.session import materialize

MIN_SITES = 3
MIN_WORDS = 3
LG_K = 10
#: Four standard errors of a sketch with 2^LG_K registers.
MARGIN = 4 * 1.04 / (1 << LG_K) ** 0.5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _line_key(line: Column) -> Column:
    """White space at the ends and its amount between words do not count."""
    return F.trim(F.regexp_replace(line, SPACES, " "))


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      site_col: str = "source", min_sites: int = MIN_SITES,
                      min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, t, line_no, first): every occurrence of a line that at least
    ``min_sites`` sites have; t is the hash of its text, first whether it is
    the first occurrence of all.  Lines with fewer than ``min_words`` words
    are left alone."""
    text = docs[text_col].cast("string")
    # keys are made inside the exploded array, so that the filter doesn't make them again
    keyed = F.transform(_lines(docs[text_col]), _line_key)
    lines = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("t"),
                        F.coalesce(docs[site_col].cast("string"), F.lit("")).alias("site"),
                        F.posexplode(keyed).alias("line_no", "key"))
    lines = lines.where(F.size(F.split("key", " ")) >= min_words).select(
        "doc_id", "t", "site", "line_no", F.xxhash64("key").alias("h"))
    place = F.struct("doc_id", "t", "line_no")
    spread = lines.groupBy("h").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("estimate"),
        F.min(place).alias("place"))
    likely = materialize(
        spread.where(F.col("estimate") >= min_sites * (1 - MARGIN))
        .select("h", "place", (F.col("estimate") >= min_sites * (1 + MARGIN)).alias("sure")), "spread")
    seen = materialize(lines.join(likely, "h"), "seen")
    exact = materialize(seen.where(~F.col("sure")).select("h", "site").distinct().groupBy("h").count()
                        .where(F.col("count") >= min_sites).select("h", F.lit(True).alias("enough")),
                        "exact")
    return (seen.join(exact, "h", "left").where(F.col("sure") | F.coalesce("enough", F.lit(False)))
            .select("doc_id", "t", "line_no", place.eqNullSafe(F.col("place")).alias("first")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS,
                removed_col: str | None = None) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text, and (if named)
    the array of their numbers (from 0), empty if the text is unchanged.

    A null text stays null and an empty one empty; a null site is a site of
    its own.  Rows with equal id and text are treated alike, so the first
    occurrence stays in each of them.  An empty table gives no row.  Other
    columns pass through, whatever their names.
    """
    found = boilerplate_lines(docs, id_col, text_col, site_col, min_sites, min_words)
    gone = found.where(~F.col("first")).groupBy("doc_id", "t").agg(
        F.array_sort(F.collect_set("line_no")).alias("lines"))
    d, names = by_place(docs), docs.columns
    text, key = F.col(f"c{names.index(text_col)}"), F.col(f"c{names.index(id_col)}")
    d = d.join(gone.hint("shuffle_hash"), key.eqNullSafe(F.col("doc_id"))
               & (F.xxhash64(text.cast("string")) == F.col("t")), "left")
    d = d.withColumn("lines", F.coalesce("lines", F.array().cast("array<int>")))
    left = F.array_join(F.filter(_lines(text), lambda x, i: ~F.array_contains("lines", i)), "\n")
    d = d.withColumn(f"c{names.index(text_col)}", F.when(F.size("lines") > 0, left).otherwise(text))
    out = d.select(*(f"c{i}" for i in range(len(names))), *(["lines"] if removed_col else []))
    return out.toDF(*names, *([removed_col] if removed_col else []))


def op4_line_dedup(spark, sf_dir):
    """doc_id, the lines before, the lines removed and the text that is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return dedup_lines(docs, removed_col="removed").select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"),
        F.array_join("removed", ",").alias("removed_lines"),
        F.length("text").cast("long").alias("n_chars_left"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP4_SQL = f"""
WITH l AS (
  SELECT doc_id, text, coalesce(source, '') AS site, u.i - 1 AS line_no, u.line,
         trim(regexp_replace(u.line, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS key
  FROM (SELECT doc_id, text, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       LATERAL (SELECT unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i) u),
k AS (
  SELECT key, min((doc_id, line_no)) AS place FROM l
  WHERE len(string_split(key, ' ')) >= {MIN_WORDS}
  GROUP BY key HAVING count(DISTINCT site) >= {MIN_SITES}),
f AS (
  SELECT l.*, k.key IS NOT NULL AND (l.doc_id, l.line_no) <> k.place AS gone
  FROM l LEFT JOIN k ON l.key = k.key),
d AS (
  SELECT doc_id, any_value(text) AS text,
         list(line ORDER BY line_no) FILTER (NOT gone) AS kept,
         coalesce(list(line_no ORDER BY line_no) FILTER (gone), []) AS gone
  FROM f GROUP BY doc_id),
t AS (SELECT *, CASE WHEN len(gone) > 0 THEN coalesce(array_to_string(kept, chr(10)), '') ELSE text END AS new
      FROM d)
SELECT doc_id, CAST(len(gone) AS BIGINT) AS n_removed, array_to_string(gone, ',') AS removed_lines,
       CAST(length(new) AS BIGINT) AS n_chars_left, sha256(coalesce(new, '')) AS text_sha256
FROM t
"""

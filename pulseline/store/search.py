"""Search in a log of lines by an inverted index.

Lines are kept in segments (one for each task that wrote some) and have a row
number in theirs.  A term is a token of a line (a run of letters and digits)
or a field with its whole text, written ``number=text``.  The index has, for
each term and segment, the sorted rows of the segment that have it.  A term
that every line has is thereby split by segments, and no list is longer than a
segment; the list of a large segment lies in pieces, which a search puts
together.  Postings lie in buckets of the term's hash, a folder for each batch.

A search reads the buckets of its terms, intersects the lists segment by
segment, and then reads only the segments in which all terms meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.functions.fields import split_fields
from pulseline.session import input_bytes

SEPARATORS = "[^A-Za-z0-9]+"
BUCKETS = 64
#: up to so many segments with hits are read by name; beyond, all lines meet the hits
NAMED_SEGMENTS = 10_000
LINES = "batch INT, seg INT, row INT, line STRING"
POSTINGS = "term STRING, seg INT, rows ARRAY<INT>, batch INT, bucket INT"
#: so many bytes of lines, about, are turned into lists at once
PIECE_BYTES = 8 << 20
#: bytes of written lines whose postings one task writes: of few lines, of many
FEW_BYTES, MANY_BYTES = 512 << 10, 8 << 20


def terms_of(line: Column, sep: str = "|") -> Column:
    """The distinct terms of a line."""
    tokens = F.filter(F.split(line, SEPARATORS), lambda x: x != "")
    fields = F.filter(F.transform(split_fields(line, sep), lambda x, i: F.when(
        x != "", F.concat(i.cast("string"), F.lit("="), x))), lambda x: x.isNotNull())
    return F.array_distinct(F.concat(tokens, fields))


def has_terms(line: Column, terms, sep: str = "|") -> Column:
    """Whether a line has all terms, by looking at it."""
    return reduce(lambda a, b: a & b, [F.array_contains(terms_of(line, sep), t) for t in terms])


_IN_TOKEN = np.zeros(256, bool)
_IN_TOKEN[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


def _tokens(lines: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """All tokens of lines, and the place of each one's line."""
    ends = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1]
    text = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    inside = _IN_TOKEN[text]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = ends[:-1][np.diff(ends) > 0]  # a line's first letter goes on with no token
    start[first] = inside[first]
    at = np.flatnonzero(start)
    offsets = np.append(np.cumsum(inside)[at] - 1, np.count_nonzero(inside)).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(text[inside]))
    return tokens, np.searchsorted(ends, at, side="right") - 1


def _lists(terms: pa.Array, code: np.ndarray, line: np.ndarray, seg: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    """(term, seg, rows): ``code`` names the terms that the lines in places
    ``line`` have; ``seg`` and ``row`` are the lines', in order."""
    code, line = np.divmod(np.unique(code.astype(np.int64) * max(1, len(seg)) + line), max(1, len(seg)))
    segs = seg[line]
    new = np.ones(len(code), bool)
    new[1:] = (np.diff(code) != 0) | (np.diff(segs) != 0)
    first = np.flatnonzero(new)
    offsets = np.append(first, len(code)).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        terms.take(pa.array(code[first])), pa.array(segs[first], pa.int32()),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(row[line], pa.int32()))], ["term", "seg", "rows"])


def _lists_of(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of the tokens and of the fields of some lines."""
    lines = pa.Table.from_batches(batches)
    lines = lines.take(pc.sort_indices(lines, sort_keys=[("seg", "ascending"), ("row", "ascending")])).combine_chunks()
    seg, row = lines["seg"].to_numpy(), lines["row"].to_numpy()
    tokens, line = _tokens(lines["line"].combine_chunks().cast(pa.string()))
    coded = tokens.dictionary_encode()
    yield _lists(coded.dictionary, coded.indices.to_numpy(), line, seg, row)
    fields = lines["fields"].combine_chunks()
    lengths = fields.value_lengths().to_numpy()
    number = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    texts, line = fields.flatten().cast(pa.string()), fields.value_parent_indices().to_numpy()
    full = pc.binary_length(texts).to_numpy() > 0
    coded = texts.filter(pa.array(full)).dictionary_encode()
    width = max(1, len(coded.dictionary))
    found, code = np.unique(number[full] * width + coded.indices.to_numpy(), return_inverse=True)
    number, text = np.divmod(found, width)
    terms = pc.binary_join_element_wise(pa.array(number).cast(pa.string()), coded.dictionary.take(pa.array(text)), "=")
    yield _lists(terms, code, line[full], seg, row)


def postings_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of the terms (``terms_of``) of lines (seg, row, line,
    fields), a piece after another."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("line"))).as_py() or 0
        if size >= PIECE_BYTES:
            yield from _lists_of(held)
            held, size = [], 0
    if size:
        yield from _lists_of(held)


@dataclass
class LineIndex:
    spark: SparkSession
    path: str
    sep: str = "|"
    buckets: int = BUCKETS

    def append(self, lines: DataFrame, batch: int, line_col: str = "value") -> None:
        """Add a batch of lines (or write it again: a batch is a folder of its
        own in both tables).  Postings are made from the written lines, whose
        row numbers no longer change."""
        kept = lines.select(F.col(line_col).alias("line")).withColumn("seg", F.spark_partition_id()).withColumn(
            "row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int"))
        kept.select("row", "line", "seg").write.mode("overwrite").partitionBy("seg").parquet(
            f"{self.path}/lines/batch={batch}")
        written = self.spark.read.schema(LINES).parquet(f"{self.path}/lines/batch={batch}")
        # a task makes lists of its lines, so lists are shuffled and not each term of each line
        postings = written.where(F.col("line").isNotNull()).select(
            "seg", "row", "line", split_fields(F.col("line"), self.sep).alias("fields")).mapInArrow(
            postings_of, "term STRING, seg INT, rows ARRAY<INT>")
        postings = postings.withColumn("bucket", self._bucket(F.col("term")))
        tasks, task = self._tasks(input_bytes(self.spark, f"{self.path}/lines/batch={batch}"))
        (postings.repartitionById(tasks, task).sortWithinPartitions("bucket", "term", "seg")
         .write.mode("overwrite").partitionBy("bucket").option("compression", "zstd")
         .parquet(f"{self.path}/postings/batch={batch}"))

    def _tasks(self, size: int) -> tuple[int, Column]:
        """How many tasks write the postings of so many bytes of lines, and
        which of them a posting's: neighbouring buckets share one, or a bucket
        is cut into equal shares of terms and segments."""
        bucket = F.col("bucket")
        shares = -(-size // (self.buckets * MANY_BYTES))
        if shares > 1:
            share = F.pmod(F.hash("term", "seg"), F.lit(shares))
            return self.buckets * shares, (bucket * shares + share).cast("int")
        tasks = min(self.buckets, max(1, -(-size // FEW_BYTES)))
        return tasks, F.floor(bucket * tasks / self.buckets).cast("int")

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def hits(self, *terms: str) -> DataFrame:
        """(batch, seg, rows) of the segments in which rows have all terms."""
        wanted = sorted(set(terms))
        if not wanted:
            raise ValueError("a search needs a term")
        buckets = sorted(set(self.spark.range(1).select(*(self._bucket(F.lit(t)) for t in wanted)).first()))
        found = self.spark.read.schema(POSTINGS).parquet(f"{self.path}/postings").where(
            F.col("bucket").isin(*buckets) & F.col("term").isin(*wanted))
        found = found.groupBy("batch", "seg", "term").agg(
            F.array_sort(F.flatten(F.collect_list("rows"))).alias("rows"))
        # a list for each term and segment: at most as many as there are terms
        met = found.groupBy("batch", "seg").agg(F.collect_list("rows").alias("lists")).where(
            F.size("lists") == len(wanted))
        rows = F.aggregate(F.slice("lists", 2, F.size("lists")), F.col("lists")[0],
                           lambda a, x: F.array_intersect(a, x))
        return met.select("batch", "seg", rows.alias("rows")).where(F.size("rows") > 0)

    def search(self, *terms: str) -> DataFrame:
        """(batch, seg, row, line) of all lines that have all terms."""
        hits = self.hits(*terms)
        segments = hits.select("batch", "seg").limit(NAMED_SEGMENTS + 1).collect()
        reader, folder = self.spark.read.schema(LINES), f"{self.path}/lines"
        if not segments:
            lines = self.spark.createDataFrame([], LINES)
        elif len(segments) <= NAMED_SEGMENTS:
            lines = reader.option("basePath", folder).parquet(
                *(f"{folder}/batch={b}/seg={s}" for b, s in segments))
        else:
            lines = reader.parquet(folder)
        at = hits.select("batch", "seg", F.explode("rows").alias("row"))
        return lines.join(at, ["batch", "seg", "row"])


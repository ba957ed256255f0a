"""Hot-key-safe running aggregates.

A running value per key over an ordered sequence is, written naively, one
window partitioned by the key: every row of a key goes to one task, and a
key holding a third of all rows becomes a third of the job in one task.

Here the order is cut into contiguous *chunks* (e.g. one day of a key's
records).  Count, sum, min and max are decomposable over contiguous
pieces, so

    running(row) = combine(totals of all earlier chunks of the key,
                           running value inside the row's own chunk)

* the within-chunk window is partitioned by (key, chunk): a hot key spreads
  over as many tasks as it has chunks;
* chunk totals come from a partial (map-side) aggregation;
* the prefix over chunks is a window over the small chunk-totals table;
* the prefix is joined back on (key, chunk): the big side is already hash-
  partitioned on (key, chunk) by its window, so only the small side moves
  (and AQE may turn that join into a broadcast from its measured size).
  Only chunks after a key's first carry a prefix, so keys that fit in one
  chunk never enter the join.

The same split gives a row's position in its key and the value of the
preceding row across chunk borders (``chunked_position``).  Results are
exact; no rows are sampled or dropped.

Chunk bounds.  ``equal_count_chunks`` gives every key with more than
``target_rows`` rows bounds at even ranks of a sample of its own rows, ordered
by the whole order (time, then sequence number), so its chunks hold about as
many rows each, however its rows are spread: bursts, outliers, and many rows
in one second.  Keys below the target are one chunk.  Results never depend on
the bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.session import materialize

_AGG = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
# how chunk totals fold into a prefix
_PREFIX = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


TARGET_ROWS = 2_000_000
SAMPLES = 100  # of a chunk's rows, about
BROADCAST_BYTES = 64 << 20


def _bytes(rows: DataFrame, columns: list[str]) -> tuple[int, int]:
    """(rows, bytes) of a table's columns, at least."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(16))
    n, total = rows.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    return n, total or 0


def equal_count_chunks(df: DataFrame, keys: list[str], order: list[str], chunk_col: str,
                       target_rows: int = TARGET_ROWS) -> DataFrame:
    """Add ``chunk_col``: the number of the row's bounds at or below it in the
    order of the columns ``order``, nulls first (0 for keys of at most
    ``target_rows`` rows).  ``df`` is read several times and should be
    written data.

    A key's bounds are rows of a sample, taken at even ranks of the sample
    that has about ``SAMPLES`` rows for each chunk; the sample of a key with
    10^12 rows is some 50 million narrow rows.  Only rows that are equal in
    the whole order can't be told apart and share a chunk.
    """
    place = F.struct(*order)
    keyed = df.select(*keys, place.alias("_v"))
    hot = materialize(keyed.groupBy(*keys).count().where(F.col("count") > target_rows), "hot")
    n_hot, hot_bytes = _bytes(hot, keys)
    if not n_hot:
        return df.withColumn(chunk_col, F.lit(0).cast("bigint"))
    small = hot.select(*keys)
    small = F.broadcast(small) if hot_bytes <= BROADCAST_BYTES else small
    share = min(1.0, SAMPLES / target_rows)
    sample = keyed.sample(share, seed=1).join(small, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_v"))
    step = max(1, round(share * target_rows))
    bounds = sample.withColumn("_r", rank).where(F.col("_r") % step == 0).groupBy(*keys).agg(
        F.array_sort(F.collect_set("_v")).alias("_b"))
    # two levels: about 2 * sqrt(n) comparisons find a row's chunk
    width = F.greatest(F.ceil(F.sqrt(F.size("_b"))), F.lit(1)).cast("int")
    bounds = materialize(bounds.withColumn("_w", width).withColumn(
        "_c", F.filter("_b", lambda x, i: (i + 1) % F.col("_w") == 0)), "bounds")
    entries = bounds.agg(F.sum(F.size("_b"))).first()[0] or 0
    few = hot_bytes + 40 * entries <= BROADCAST_BYTES
    d = df.withColumn("_v", place).join(F.broadcast(bounds) if few else bounds, keys, "left")
    v = F.col("_v")
    d = d.withColumn("_k", F.size(F.filter("_c", lambda x: x <= v)) * F.col("_w"))
    inside = F.size(F.filter(F.slice("_b", F.col("_k") + 1, F.col("_w")), lambda x: x <= v))
    return d.withColumn(chunk_col, F.coalesce(F.col("_k") + inside, F.lit(0)).cast("bigint")).select(
        *df.columns, chunk_col)


MOST_RANGES = 1 << 20


def number_ranges(df: DataFrame, number: str, chunk_col: str, target_rows: int,
                  most_ranges: int = MOST_RANGES) -> DataFrame:
    """Add ``chunk_col``: consecutive ranges of an integer column that hold
    ``target_rows`` rows each, more where there would be over ``most_ranges``
    of them; null where the number is null.

    Bounds come from counts of rows, not from the span of the numbers, so
    outliers change nothing.  Only the numbers are shuffled.  The bounds, 8
    bytes each, are few enough for the driver; they reach the rows as a short
    list of blocks and a broadcast table of the bounds of each block.
    """
    spark = df.sparkSession
    numbers = df.select(F.col(number).cast("bigint").alias("_v")).where(F.col("_v").isNotNull())
    n = numbers.count()
    step = max(target_rows, -(-n // most_ranges))
    if n <= step:
        return df.withColumn(chunk_col, F.when(F.col(number).isNotNull(), F.lit(0)).cast("bigint"))
    dealt = numbers.repartitionByRange("_v").withColumn("_p", F.spark_partition_id())
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_v"))
    # the last row of a range of numbers is a bound too, so no range goes on into the next
    bounds = dealt.withColumn("_r", rank).groupBy("_p").agg(F.collect_set(
        F.when(F.col("_r") % step == 0, F.col("_v"))).alias("_b"), F.max("_v").alias("_m"))
    bounds = bounds.select(F.explode(F.array_append("_b", F.col("_m"))).alias("_v")).distinct()
    found = np.sort(bounds.toArrow()["_v"].to_numpy())
    width = max(1, round(len(found) ** 0.5))
    blocks = [found[i:i + width].tolist() for i in range(0, len(found), width)]
    table = spark.createDataFrame(pa.table({"_g": pa.array(range(len(blocks)), pa.int32()), "_b": blocks}))
    v = F.col(number).cast("bigint")
    # bounds are the last numbers of their ranges
    ends = F.array(*(F.lit(b[-1]).cast("bigint") for b in blocks))
    d = df.withColumn("_g", F.when(v.isNotNull(), F.size(F.filter(ends, lambda x: x < v))))
    d = d.join(F.broadcast(table), "_g", "left")
    inside = F.size(F.filter("_b", lambda x: x < v))
    chunk = (F.col("_g") * width + F.when(F.col("_b").isNotNull(), inside).otherwise(0)).cast("bigint")
    return d.withColumn(chunk_col, chunk).select(*df.columns, chunk_col)


def _combine(kind: str, prefix: Column, local: Column) -> Column:
    if kind in ("count", "sum"):
        return F.coalesce(prefix, F.lit(0)) + local
    if kind == "min":
        return F.least(prefix, local)      # least/greatest skip NULLs
    return F.greatest(prefix, local)


def _before(keys: list[str], chunk_col: str):
    return (Window.partitionBy(*keys).orderBy(chunk_col)
            .rowsBetween(Window.unboundedPreceding, -1))


def _sorted(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def chunked_running(df: DataFrame, keys: list[str], chunk_col: str, order: list[str],
                    measures: dict[str, tuple[str, Column]],
                    totals_from_window: bool = False) -> DataFrame:
    """Add running aggregates per key along ``order``.

    ``measures`` maps output name -> (kind, column), kind in count/sum/min/
    max.  ``chunk_col`` names an existing column that is non-decreasing
    along ``order`` within a key (e.g. a day number when ordering by time).
    ``order`` lists column names, ascending with NULLs first, and should be
    unique within a key so running values are deterministic.

    ``totals_from_window`` takes the chunk totals from the last row of each
    chunk's window, so that they share its exchange and ``df`` is computed
    once; by default they are a partial aggregate of ``df``, which moves less
    but reads it again.
    """
    part = keys + [chunk_col]
    w_in = (Window.partitionBy(*part).orderBy(*_sorted(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.select(
        "*", *[_AGG[kind](c).over(w_in).alias(f"_l_{name}")
               for name, (kind, c) in measures.items()])

    if totals_from_window:
        after = F.lead(F.lit(1)).over(Window.partitionBy(*part).orderBy(*_sorted(order)))
        totals = local.withColumn("_after", after).where(F.col("_after").isNull()).select(
            *part, *[F.col(f"_l_{name}").alias(f"_t_{name}") for name in measures])
    else:
        totals = df.groupBy(*part).agg(
            *[_AGG[kind](c).alias(f"_t_{name}") for name, (kind, c) in measures.items()])
    prefix = totals.select(
        *part, *[_PREFIX[kind](F.col(f"_t_{name}")).over(_before(keys, chunk_col))
                 .alias(f"_p_{name}") for name, (kind, _) in measures.items()])

    # only chunks after a key's first carry a prefix; the first chunks (all
    # chunks of keys that fit in one) stay out of the join
    prefix = prefix.filter(F.col(f"_p_{next(iter(measures))}").isNotNull())
    joined = local.join(prefix, on=part, how="left")
    return joined.select(
        *df.columns,
        *[_combine(kind, F.col(f"_p_{name}"), F.col(f"_l_{name}")).alias(name)
          for name, (kind, _) in measures.items()])


def chunked_position(df: DataFrame, keys: list[str], chunk_col: str, order: list[str],
                     value: str, pos_name: str = "pos", prev_name: str = "prev") -> DataFrame:
    """Add the 1-based position of each row in its key and the ``value`` of
    the preceding row of the key (NULL for the first)."""
    part = keys + [chunk_col]
    w_in = Window.partitionBy(*part).orderBy(*_sorted(order))
    local = df.select("*", F.row_number().over(w_in).alias("_rn"),
                      F.lag(value).over(w_in).alias("_lag"))
    ord_struct = F.struct(*[F.col(c) for c in order])
    totals = df.groupBy(*part).agg(F.count(F.lit(1)).alias("_cnt"),
                                   F.max_by(F.col(value), ord_struct).alias("_last"))
    w_ck = Window.partitionBy(*keys).orderBy(chunk_col)
    prefix = totals.select(
        *part,
        F.sum("_cnt").over(_before(keys, chunk_col)).alias("_before"),
        F.lag("_last").over(w_ck).alias("_prev_last")).filter(F.col("_before").isNotNull())
    joined = local.join(prefix, on=part, how="left")
    return joined.select(
        *df.columns,
        (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_rn")).alias(pos_name),
        F.when(F.col("_rn") == 1, F.col("_prev_last")).otherwise(F.col("_lag")).alias(prev_name))

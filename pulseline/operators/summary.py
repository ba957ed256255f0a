"""Per-key summaries of trial records: final totals, running values, merge
of partial summaries, record counts.

``summary`` and ``merge_summaries`` are plain aggregations (partial
aggregation before the shuffle, so a hot key costs one small partial row per
map task).  ``running_summary`` uses the chunked prefix scheme of
``operators.running`` so a hot key is spread over its chunks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.functions.fields import wall_seconds
from pulseline.operators.running import chunked_running, equal_count_chunks
from pulseline.session import materialize

KEY = "record_key"
IDENTITY = ["trial_id", "patient_id", "visit_name"]


# explicit record order within a key: observation start, then sequence
ORDER = ["start_ts", "seq"]
CHUNK = "_chunk"


def with_time_chunk(records: DataFrame, key: str = KEY, chunk_seconds="auto") -> DataFrame:
    """Add contiguous order chunks: ``chunk_seconds`` of observation time, or
    (``"auto"``) about equally many rows of a large key, see
    ``operators.running``."""
    if chunk_seconds == "auto":
        return equal_count_chunks(records, [key], ORDER, CHUNK)
    secs = wall_seconds(F.col("start_date"), F.col("start_time"))
    return records.withColumn(CHUNK, F.floor(secs / F.lit(int(chunk_seconds))).cast("bigint"))


def _avg_cols(n: str, s: str) -> list[Column]:
    return [
        F.expr(f"{s} div greatest({n}, 1)").cast("bigint").alias("avg_int"),
        (F.col(s).cast("double") / F.col(n).cast("double")).alias("avg_value"),
    ]


def _last_order() -> Column:
    """(start_ts, seq) as one number, for an aggregate that stays a hash one."""
    seq = F.coalesce(F.col("seq"), F.lit(-(1 << 63)).cast("bigint")).cast("decimal(20,0)")
    secs = F.unix_seconds(F.col("start_ts").cast("timestamp")).cast("decimal(18,0)")
    return F.coalesce((secs * F.lit(Decimal(10 ** 19)).cast("decimal(20,0)") + seq).cast("decimal(38,0)"), seq)


def combine_partial(parts: DataFrame, key: str = KEY, by=()) -> DataFrame:
    """One partial summary per key (and ``by`` columns) from many; the
    identity is that of the part with the latest record."""
    return parts.groupBy(*by, key).agg(
        *[F.max_by(c, "last_order").alias(c) for c in IDENTITY],
        F.sum("n_records").cast("bigint").alias("n_records"),
        F.sum("sum_value").cast("bigint").alias("sum_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.max("last_order").alias("last_order"))


def finish_summary(parts: DataFrame, key: str = KEY) -> DataFrame:
    """The summary that a key's one partial summary stands for."""
    return parts.select(key, *IDENTITY, "n_records", "sum_value", "min_value", "max_value",
                        *_avg_cols("n_records", "sum_value"))


def _merge(parts: DataFrame, key: str) -> DataFrame:
    """One row per key from partial summaries.  Parts are few: one per key and
    identity."""
    return finish_summary(combine_partial(parts, key), key)


def partial_summary(records: DataFrame, key: str = KEY, by=()) -> DataFrame:
    """Partial summaries per key, identity and ``by`` columns: a hash
    aggregate with one small row per group and map task."""
    return records.groupBy(key, *IDENTITY, *by).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum("value").cast("bigint").alias("sum_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max(_last_order()).alias("last_order"))


def summary(records: DataFrame, key: str = KEY) -> DataFrame:
    """Final summary per key: count, sum, min, max, integer and exact average,
    and the identity of the key's latest record.  The key may be coarser than
    the identity (e.g. a patient's visits)."""
    return _merge(partial_summary(records, key), key)


def running_summary(records: DataFrame, key: str = KEY, chunk_seconds="auto") -> DataFrame:
    """Every record with the summary of its key up to and including itself."""
    measures = {
        "run_count": ("count", F.lit(1)),
        "run_sum": ("sum", F.col("value").cast("bigint")),
        "run_min": ("min", F.col("value")),
        "run_max": ("max", F.col("value")),
    }
    # the narrow keyed records are written once; sizing the chunks, the
    # window and the chunk totals then all read that instead of the input
    narrow = materialize(records.select(key, *IDENTITY, "value", "start_ts", "seq",
                                        "start_date", "start_time"))
    base = with_time_chunk(narrow, key, chunk_seconds).select(
        key, *IDENTITY, "value", "start_ts", "seq", CHUNK)
    out = chunked_running(base, [key], CHUNK, ORDER, measures)
    return out.select(
        key, *IDENTITY, "value", "start_ts", "seq",
        F.col("run_count").cast("bigint").alias("run_count"),
        F.col("run_sum").cast("bigint").alias("run_sum"),
        "run_min", "run_max",
        *_avg_cols("run_count", "run_sum")).withColumnsRenamed(
            {"avg_int": "run_avg_int", "avg_value": "run_avg"})


def merge_summaries(*parts: DataFrame, key: str = KEY) -> DataFrame:
    """Merge partial summaries of the same keys (``partial_summary`` of
    several batches, or one of several groups): counts and sums add, min/max
    take the extreme, averages are recomputed, the identity is the latest."""
    cols = [key, *IDENTITY, "n_records", "sum_value", "min_value", "max_value", "last_order"]
    u = parts[0].select(*cols)
    for p in parts[1:]:
        u = u.unionByName(p.select(*cols))
    return _merge(u, key)


def record_count(records: DataFrame) -> DataFrame:
    """Number of records seen (one row)."""
    return records.agg(F.count(F.lit(1)).alias("n_records"))

"""The reference program's literal per-key fold, kept for compatibility.

The streaming summary of the original program folds each key's records
with these rules (differences from a plain running min/max are on purpose):

* the first record of a key emits a blank summary (identity '', max 0,
  min 1000, count 0, sum 0) and is not counted;
* max becomes the value when it exceeds the previous max, else 0;
* min becomes the value when it is below the previous min, else 2147483647;
* count and sum then grow by one record / its value; avg = sum div count.

Closed form (no per-row state, so it runs as windows): number a key's
records n = 1..N and let p be the preceding value, except that at n = 2
the preceding max is 0 and min 1000.  A row "rises" when n = 1 or
v > p (for min: v < p).  Inside a run of non-rising rows the output
alternates reset / value: with r = n - (position of the last rise),
r even -> v, r odd -> 0 (max) or 2147483647 (min).  The max state is never
negative, so a value at or below 0 never beats it: the max side works on
greatest(v, 0).  Valid for v < 2147483647.

Position, preceding value and "last rise" are all computed with the
chunked scheme of ``operators.running``, so a hot key is spread over its
chunks instead of one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.operators.running import chunked_position, chunked_running
from pulseline.operators.summary import CHUNK, IDENTITY, KEY, ORDER, with_time_chunk
from pulseline.session import materialize

# Fixed values of the literal fold.
BLANK_MAX = 0
BLANK_MIN = 1000
RESET_MIN = 2147483647


def compat_running(records: DataFrame, key: str = KEY, chunk_seconds="auto") -> DataFrame:
    """One output row per record: the literal fold's summary after it."""
    # two chunked passes; each starts from written data, so the input is
    # read once and the first pass is not recomputed by the second
    narrow = materialize(records.select(key, *IDENTITY, "value", *ORDER,
                                        "start_date", "start_time"))
    base = with_time_chunk(narrow, key, chunk_seconds).select(
        key, *IDENTITY, "value", *ORDER, CHUNK)
    pos = materialize(
        chunked_position(base, [key], CHUNK, ORDER, "value", pos_name="n", prev_name="p"))
    n, v, p = F.col("n"), F.col("value"), F.col("p")
    high = F.greatest(v, F.lit(0))
    rises = pos.select(
        "*",
        ((n == 1) | (high > F.when(n == 2, F.lit(BLANK_MAX)).otherwise(F.greatest(p, F.lit(0)))))
        .alias("rise_max"),
        ((n == 1) | (v < F.when(n == 2, F.lit(BLANK_MIN)).otherwise(p))).alias("rise_min"))
    runs = chunked_running(rises, [key], CHUNK, ORDER, {
        "last_rise_max": ("max", F.when(F.col("rise_max"), n)),
        "last_rise_min": ("max", F.when(F.col("rise_min"), n)),
        "tail_sum": ("sum", F.when(n >= 2, v.cast("bigint")).otherwise(F.lit(0).cast("bigint"))),
    })
    r_max = n - F.col("last_rise_max")
    r_min = n - F.col("last_rise_min")
    first = n == 1
    count = (n - 1).cast("bigint")
    return runs.select(
        key,
        *[F.when(first, F.lit("")).otherwise(F.col(c)).alias(c) for c in IDENTITY],
        "value", *ORDER,
        F.when(first, F.lit(BLANK_MAX)).when(r_max % 2 == 1, F.lit(0)).otherwise(high)
        .alias("max_value"),
        F.when(first, F.lit(BLANK_MIN)).when(r_min % 2 == 1, F.lit(RESET_MIN)).otherwise(v)
        .alias("min_value"),
        count.alias("n_records"),
        F.col("tail_sum").cast("bigint").alias("sum_value"),
        F.expr("tail_sum div greatest(n - 1, 1)").cast("bigint").alias("avg_int"),
    )


def compat_latest(records: DataFrame, key: str = KEY, chunk_seconds="auto") -> DataFrame:
    """The last literal summary per key (what a keyed upsert store keeps)."""
    from pulseline.operators.report import latest_by_key
    return latest_by_key(compat_running(records, key, chunk_seconds), key=key, order=ORDER)

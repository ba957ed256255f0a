import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulseline.operators.running import equal_count_chunks, number_ranges
from pulseline.operators.summary import merge_summaries, partial_summary, running_summary, summary


def _records(spark):
    """One hot key holding most rows across many days, plus small keys."""
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "HOT" if i % 3 else f"K{i % 17}"
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=37 * i)
        rows.append((key, "T", "P", "V", rnd.randint(0, 300), ts, i, ts.date(),
                     ts.hour * 10000 + ts.minute * 100 + ts.second))
    return spark.createDataFrame(
        rows, "record_key STRING, trial_id STRING, patient_id STRING, visit_name STRING, "
              "value INT, start_ts TIMESTAMP_NTZ, seq BIGINT, start_date DATE, start_time INT")


def test_chunked_running_equals_single_window(spark):
    df = _records(spark)
    w = (Window.partitionBy("record_key").orderBy("start_ts", "seq")
         .rowsBetween(Window.unboundedPreceding, 0))
    plain = df.select("seq", F.count(F.lit(1)).over(w).alias("c"), F.sum("value").over(w).alias("s"),
                      F.min("value").over(w).alias("lo"), F.max("value").over(w).alias("hi"))
    want = {r.seq: (r.c, r.s, r.lo, r.hi) for r in plain.collect()}
    for width in ("auto", 3600, 86400, 3 * 86400):
        got = {r.seq: (r.run_count, r.run_sum, r.run_min, r.run_max)
               for r in running_summary(df, chunk_seconds=width).collect()}
        assert got == want


def test_merge_of_halves_equals_whole(spark):
    df = _records(spark)
    am = F.hour("start_ts") < 12
    merged = merge_summaries(partial_summary(df.filter(am)), partial_summary(df.filter(~am)))
    cols = ["record_key", "n_records", "sum_value", "min_value", "max_value", "avg_int", "avg_value"]
    assert sorted(merged.select(cols).collect()) == sorted(summary(df).select(cols).collect())


def test_chunks_hold_equal_counts_despite_outliers_and_bursts(spark):
    """One stamp far away, a key whose rows crowd in a short time, small keys."""
    rows = [("spread", i * 1000) for i in range(30_000)] + [("spread", 10 ** 12)]
    rows += [("burst", 5_000_000 + i) for i in range(9_000)] + [("burst", i * 10_000) for i in range(1_000)]
    rows += [(f"k{i % 50}", i) for i in range(2_000)]
    df = spark.createDataFrame(rows, "key STRING, v BIGINT")
    got = equal_count_chunks(df, ["key"], ["v"], "c", target_rows=1_000)
    sizes = {(r.key, r.c): (r["count"], r.lo, r.hi) for r in got.groupBy("key", "c").agg(
        F.count(F.lit(1)).alias("count"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    assert max(n for n, _, _ in sizes.values()) <= 2_000
    assert len([1 for k, _ in sizes if k == "spread"]) >= 25
    assert all(c == 0 for k, c in sizes if k.startswith("k"))
    for key in ("spread", "burst"):  # chunks are ranges of the order value
        ends = [(lo, hi) for (k, c), (_, lo, hi) in sorted(sizes.items()) if k == key]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_rows_of_one_second_are_split_by_their_sequence(spark):
    """18,000 of a key's 20,000 rows in one second: chunks end inside it."""
    rows = [("hot", 500 if i < 18_000 else i % 1_000, i) for i in range(20_000)] + [("hot", None, None)]
    rows += [("small", 500, i) for i in range(300)]
    df = spark.createDataFrame(rows, "key STRING, t BIGINT, seq BIGINT")
    got = equal_count_chunks(df, ["key"], ["t", "seq"], "c", target_rows=1_000)
    by = {(r.key, r.c): r for r in got.groupBy("key", "c").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct("t", "seq")).alias("lo"),
        F.max(F.struct("t", "seq")).alias("hi")).collect()}
    sizes = [r.rows for (k, _), r in by.items() if k == "hot"]
    assert max(sizes) <= 2_000 and len(sizes) >= 15 and by["small", 0].rows == 300
    order = [by["hot", c] for c in sorted(c for k, c in by if k == "hot")]
    ends = [((r.lo.t or -1, r.lo.seq or -1), (r.hi.t, r.hi.seq)) for r in order]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_number_ranges_follow_counts_not_spans(spark):
    numbers = [*range(1, 5_001), 2 ** 60, -2 ** 61, *[70_000] * 30, None]
    df = spark.createDataFrame([(x, "text") for x in numbers], "doc_id BIGINT, text STRING").repartition(5)
    got = number_ranges(df, "doc_id", "c", 64)
    assert got.columns == ["doc_id", "text", "c"] and got.count() == len(numbers)
    by = {r.c: r for r in got.groupBy("c").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("lo"),
                                               F.max("doc_id").alias("hi")).collect()}
    assert by.pop(None).rows == 1
    assert max(r.rows for r in by.values()) <= 64 + 30 and len(by) >= 78
    order = [by[c] for c in sorted(by)]
    assert all(a.hi < b.lo for a, b in zip(order, order[1:]))
    few = number_ranges(df, "doc_id", "c", 64, most_ranges=10)
    assert 8 <= few.select("c").distinct().count() <= 10 + 8 + 1
    one = number_ranges(df.limit(3), "doc_id", "c", 64)
    assert {r.c for r in one.collect()} <= {0, None}


def test_results_do_not_depend_on_chunks(spark, monkeypatch):
    from pulseline.operators import compat, running
    df = _records(spark)
    plain = sorted(running_summary(df).collect()), sorted(compat.compat_running(df).collect())
    monkeypatch.setattr(running.equal_count_chunks, "__defaults__", (100,))
    assert (sorted(running_summary(df).collect()), sorted(compat.compat_running(df).collect())) == plain


def test_key_coarser_than_identity_has_one_row(spark):
    df = _records(spark).withColumn("visit_name", F.concat(F.lit("V"), F.col("seq") % 5))
    got = summary(df).collect()
    assert len(got) == len({r.record_key for r in got}) == 18
    last = {r.record_key: r.v for r in df.groupBy("record_key").agg(
        F.max_by("visit_name", F.struct("start_ts", "seq")).alias("v")).collect()}
    assert {r.record_key: r.visit_name for r in got} == last


def test_cluster_settings_scale_with_input():
    from pulseline.session import cluster_settings
    small = cluster_settings(10 * 1024 ** 2, cores=8)
    big = cluster_settings(100 * 1024 ** 4, cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 50_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"

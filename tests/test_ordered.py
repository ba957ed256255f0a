"""Running summaries in order of time from records that come out of order."""

import random

from conftest import hr_line
from pulseline.operators import records as rec
from pulseline.operators.summary import running_summary
from pulseline.session import scratch_path
from pulseline.sources.lines import read_lines
from pulseline.streaming import ordered as od
from pulseline.streaming import queries as sq


def lines(n):
    """One record a quarter of an hour, two keys; some share a time."""
    return [hr_line(patient=f"{i % 2:09d}", value=str(40 + (i * 37) % 60), day=f"{1 + i // 96:02d}JAN2024",
                    time=f"{i // 4 % 24:02d}{15 * (i // 2 * 2 % 4):02d}00", seq=str(i)) for i in range(n)]


def arrive(spark, root, some):
    spark.createDataFrame([(x,) for x in some], "value STRING").coalesce(1).write.mode("append").text(f"{root}/in")


def run(spark, root, delay="5 hours"):
    stream = rec.trial_records(read_lines(spark, f"{root}/in", mode="stream", max_files_per_trigger=1))
    sq.await_all([od.start_ordered(spark, stream, f"{root}/out", delay, available_now=True, buckets=3)])


def rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def batch(spark, some):
    return running_summary(rec.trial_records(spark.createDataFrame([(x,) for x in some], "value STRING")))


def test_any_order_within_the_delay_gives_the_batch_rows(spark):
    root, some = scratch_path(spark, "ordered"), lines(120)
    rnd = random.Random(1)
    shuffled = [x for _, x in sorted((i + rnd.uniform(0, 19), x) for i, x in enumerate(some))]
    for i in range(0, 120, 30):
        arrive(spark, root, shuffled[i:i + 30])
    run(spark, root)
    out = od.ordered_summaries(spark, f"{root}/out")
    before = rows(out)
    want = rows(batch(spark, some))
    assert set(before) < set(want)  # what is out is final; the last hours wait
    od.flush(spark, f"{root}/out")
    run(spark, root)
    assert rows(od.ordered_summaries(spark, f"{root}/out")) == want
    assert od.late_records(spark, f"{root}/out").count() == 0


def test_records_beyond_the_delay_are_counted_as_late(spark):
    root, some = scratch_path(spark, "ordered"), lines(96)
    late, rest = some[3:9], some[:3] + some[9:]
    arrive(spark, root, rest[:70])
    run(spark, root)  # the query stops here and goes on from its state
    arrive(spark, root, rest[70:])
    run(spark, root)
    arrive(spark, root, late + lines(96)[:0])
    run(spark, root)
    od.flush(spark, f"{root}/out")
    run(spark, root)
    assert rows(od.ordered_summaries(spark, f"{root}/out")) == rows(batch(spark, rest))
    seq = sorted(r.seq for r in od.late_records(spark, f"{root}/out").collect())
    assert seq == [3, 4, 5, 6, 7, 8]
    assert len(rest) + len(seq) == 96

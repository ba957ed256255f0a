"""The one-pass sensor query, its dead letters and replays."""

from dataclasses import replace

import pytest

from conftest import hr_line
from pulseline.config import SensorConfig
from pulseline.operators import records as rec
from pulseline.operators.report import flag_alerts, latest_by_key
from pulseline.operators.summary import running_summary, summary
from pulseline.session import scratch_path
from pulseline.sources.lines import read_lines
from pulseline.streaming import onepass as op
from pulseline.streaming import queries as sq


def good(n, start=0, sep="|"):
    return [hr_line(patient=f"{i % 3:09d}", visit=f"S0{i % 2}", value=str(30 + (i * 37) % 60),
                    day=f"{1 + i // 12:02d}JAN2024", time=f"{i % 12:02d}0000", seq=str(i), sep=sep)
            for i in range(start, start + n)]


BAD = {"bad_int:result": hr_line(value="x"), "missing_key": hr_line(trial=""),
       "bad_date:start_date": hr_line(day="31FEB2024"), "bad_time:start_time": hr_line(time="256161"),
       "bad_date:end_date": hr_line(end_day="soon"), "bad_time:end_time": hr_line(end_time="120099"),
       "short_line": "HR DAILY|MEASUREMENT|SUMMARY (MEAN) HEART RATE"}
OTHER = ["a line of another category", ""]


def arrive(spark, root, lines):
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.mode("append").text(f"{root}/in")


def run(spark, cfg, out):
    qs = op.start_one_pass(spark, cfg, out, available_now=True, buckets=4)
    sq.await_all(qs)
    return qs["log"]


def rows(df, columns=None):
    columns = sorted(columns or df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def batch(spark, lines, cfg):
    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    return rec.trial_records(df, sep=cfg.separator, base=cfg.base_value, key_cols=cfg.key_columns)


def test_all_lines_are_accounted_for_over_a_restart(spark):
    root = scratch_path(spark, "onepass")
    cfg = SensorConfig(path=f"{root}/in")
    lines = good(30)
    arrive(spark, root, lines[:14] + list(BAD.values()) + OTHER)
    q = run(spark, cfg, f"{root}/out")
    seen = q.lastProgress.observedMetrics["lines"]
    assert (seen["read"], seen["kept"]) == (21, 14) and all(seen[r] == 1 for r in BAD)
    arrive(spark, root, lines[14:] + [BAD["missing_key"]])
    run(spark, cfg, f"{root}/out")
    run(spark, cfg, f"{root}/out")  # nothing new
    letters = op.dead_letters(spark, f"{root}/out").collect()
    assert sorted((r.reason, r.raw) for r in letters) == sorted([*BAD.items(), ("missing_key", BAD["missing_key"])])
    assert all(r.origin.startswith("file:") and r.attempt == 0 for r in letters)
    assert len({r.letter for r in letters}) == 8
    kept = op.records(spark, f"{root}/out")
    assert kept.count() + len(letters) == 38
    want = batch(spark, lines, cfg)
    assert rows(kept) == rows(want)
    assert rows(op.summaries(spark, f"{root}/out")) == rows(running_summary(want))
    assert rows(op.totals(spark, f"{root}/out")) == rows(summary(want))
    loud = ["record_key", "start_ts", "seq", "value", "variance", "alert"]
    assert rows(op.alerts(spark, f"{root}/out")) == rows(flag_alerts(want), loud)


def test_one_scan_and_one_parse_give_what_four_queries_gave(spark):
    root = scratch_path(spark, "onepass")
    cfg = SensorConfig(path=f"{root}/in", max_files_per_trigger=1)
    for i in range(3):
        arrive(spark, root, good(10, 10 * i) + list(BAD.values()))
    q = op.start_one_pass(spark, cfg, f"{root}/one", available_now=True, buckets=4)["log"]
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert plan.count("FileScan text") == 1 and plan.count("split(value") == 1
    sq.await_all(sq.start_from_config(spark, cfg, f"{root}/four", available_now=True))
    sq.feed_totals(spark, sq.configured_records(spark, cfg), f"{root}/four")
    one, four = f"{root}/one", f"{root}/four"
    assert rows(op.records(spark, one)) == rows(spark.read.parquet(f"{four}/records"))
    assert rows(op.summaries(spark, one)) == rows(spark.read.parquet(f"{four}/summary"))
    assert rows(op.totals(spark, one)) == rows(sq.sensor_totals(spark, four))
    loud = ["record_key", "start_ts", "seq", "value", "variance", "alert"]
    assert rows(op.alerts(spark, one)) == rows(spark.read.parquet(f"{four}/alerts"), loud)


def test_replays_add_each_record_once(spark):
    root = scratch_path(spark, "onepass")
    out, cfg = f"{root}/out", SensorConfig(path=f"{root}/in")
    arrive(spark, root, good(8) + good(6, 8, ",") + good(4, 14, ";") + [BAD["missing_key"]])
    run(spark, cfg, out)
    assert op.dead_letters(spark, out).count() == 11
    comma = replace(cfg, separator=",")
    op.replay_all(spark, cfg, comma, out, buckets=4)
    op.replay_all(spark, cfg, cfg, out, buckets=4)  # the open ones once more, nothing else
    assert op.records(spark, out).count() == 14
    # lost between the replay and the program's batch, then started again
    sq.await_all([op.replay(spark, replace(cfg, separator=";"), out)])
    sq.await_all([op.replay(spark, comma, out)])
    run(spark, cfg, out)
    run(spark, cfg, out)
    want = batch(spark, good(18), cfg)
    assert rows(op.records(spark, out)) == rows(want)
    assert rows(op.totals(spark, out)) == rows(summary(want))
    assert rows(latest_by_key(op.records(spark, out))) == rows(latest_by_key(want))
    left = op.dead_letters(spark, out).collect()
    assert [(r.raw, r.attempt) for r in left] == [(BAD["missing_key"], 3)]
    # a new line after all of that
    arrive(spark, root, good(5, 18))
    run(spark, cfg, out)
    assert rows(op.totals(spark, out)) == rows(summary(batch(spark, good(23), cfg)))


def test_totals_of_a_coarser_key_have_the_latest_identity(spark):
    root = scratch_path(spark, "onepass")
    cfg = SensorConfig(path=f"{root}/in", key_columns=("patient_id",))
    lines = good(24)
    arrive(spark, root, lines[12:])
    run(spark, cfg, f"{root}/out")
    arrive(spark, root, lines[:12])  # older ones arrive later
    run(spark, cfg, f"{root}/out")
    assert rows(op.totals(spark, f"{root}/out")) == rows(summary(batch(spark, lines, cfg)))


@pytest.mark.parametrize("lines", [[], list(BAD.values()), OTHER])
def test_batches_without_a_good_line(spark, lines):
    root = scratch_path(spark, "onepass")
    cfg = SensorConfig(path=f"{root}/in")
    arrive(spark, root, lines)
    run(spark, cfg, f"{root}/out")
    stream = rec.trial_records(read_lines(spark, f"{root}/in"))
    assert stream.count() == 0
    if lines == list(BAD.values()):
        assert op.dead_letters(spark, f"{root}/out").count() == 7 and op.records(spark, f"{root}/out").count() == 0

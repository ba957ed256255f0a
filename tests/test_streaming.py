import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF001, hr_line

from pulseline.config import SensorConfig
from pulseline.operators import records as rec
from pulseline.operators.summary import summary
from pulseline.plans.oracle import SQL
from pulseline.plans.streams import STREAM_PLANS
from pulseline.session import scratch_path
from pulseline.sources.lines import read_lines
from pulseline.streaming import queries as sq


def _write(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1) \
        .write.mode("append").text(folder)


def _lines(n, start=0):
    out = []
    for i in range(start, start + n):
        out.append(hr_line(patient=f"00000000{i % 3}", value=str(40 + (i * 37) % 90),
                           day=f"{1 + i // 4:02d}JAN2024", time=f"{(i % 4) * 5:02d}0000",
                           seq=str(i)))
    return out


def test_config_runner_recovers_from_checkpoint(spark):
    root = scratch_path(spark, "test")
    src, out = f"{root}/in", f"{root}/out"
    cfg = SensorConfig.from_dict({"path": src, "max_files_per_trigger": 1,
                                  "checkpoint": f"{root}/ckpt"})
    all_lines = _lines(24)
    _write(spark, src, all_lines[:8])
    _write(spark, src, all_lines[8:12] + [hr_line(value="x")])   # one reject
    qs = sq.start_from_config(spark, cfg, out, available_now=True)
    sq.await_all(qs)
    assert sq.records_seen(spark, out) == 12
    # stop, more files arrive, restart from the same checkpoint
    _write(spark, src, all_lines[12:])
    sq.await_all(sq.start_from_config(spark, cfg, out, available_now=True))

    batch = rec.trial_records(spark.createDataFrame([(x,) for x in all_lines], "value STRING"))
    want = {r.record_key: (r.n_records, r.sum_value, r.min_value, r.max_value)
            for r in summary(batch).collect()}
    run = spark.read.parquet(f"{out}/summary")
    got = {}
    for r in run.collect():
        if r.record_key not in got or r.run_count > got[r.record_key][0]:
            got[r.record_key] = (r.run_count, r.run_sum, r.run_min, r.run_max)
    assert got == want
    assert run.count() == 24 and sq.records_seen(spark, out) == 24
    records = sq.configured_records(spark, cfg)
    assert sq.feed_totals(spark, records, out, cfg.checkpoint)
    assert not sq.feed_totals(spark, records, out, cfg.checkpoint)
    totals = sq.sensor_totals(spark, out).collect()
    assert {r.record_key: (r.n_records, r.sum_value, r.min_value, r.max_value) for r in totals} == want
    alerts = spark.read.parquet(f"{out}/alerts")
    assert alerts.count() == sum(abs(40 + (i * 37) % 90 - 50) > 10 for i in range(24))


def test_records_seen_does_not_rest_on_kept_progress(spark):
    root = scratch_path(spark, "test")
    for i in range(5):
        _write(spark, f"{root}/in", _lines(4, start=4 * i))
    cfg = SensorConfig.from_dict({"path": f"{root}/in", "max_files_per_trigger": 1})
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        sq.await_all(sq.start_from_config(spark, cfg, f"{root}/out", available_now=True))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sq.records_seen(spark, f"{root}/out") == 20


def test_update_mode_totals_with_builtin_aggregation(spark):
    root = scratch_path(spark, "test")
    _write(spark, f"{root}/in", _lines(10))
    stream = spark.readStream.format("text").load(f"{root}/in")
    q = (sq.summary_updates_stream(rec.trial_records(stream)).writeStream
         .format("memory").queryName("upd_totals").outputMode("update")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.record_key: r.n_records for r in spark.sql("SELECT * FROM upd_totals").collect()}
    assert sum(got.values()) == 10 and len(got) == 3
    texts = spark.readStream.format("text").load(f"{root}/in").selectExpr("1L AS doc_id", "value AS text")
    q = (sq.word_totals_stream(texts).writeStream.format("memory").queryName("upd_words").outputMode("update")
         .option("checkpointLocation", f"{root}/ckpt2").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert sum(r.n for r in spark.sql("SELECT * FROM upd_words").collect()) == sum(
        len(x.split(" ")) for x in _lines(10))


def test_seeded_word_stream(spark):
    root = scratch_path(spark, "test")
    for i, t in enumerate(["hello a  b", "", "a b hello"]):
        spark.createDataFrame([(i, t)], "doc_id BIGINT, text STRING").write.mode("append") \
            .parquet(f"{root}/in")
    stream = (spark.readStream.schema("doc_id BIGINT, text STRING")
              .option("maxFilesPerTrigger", "1").parquet(f"{root}/in"))
    sq.await_all([sq.start_word_count(spark, stream, f"{root}/out", available_now=True)])
    got = {}
    for r in spark.read.parquet(f"{root}/out/words").orderBy("doc_id", "pos").collect():
        got.setdefault(r.word, []).append(r.n)
    assert got == {"hello": [2, 3], "a": [1, 2], "b": [1, 2], "": [1, 2]}


def test_command_line_sensor_once(spark):
    from pulseline.__main__ import main
    root = scratch_path(spark, "test-cli")
    _write(spark, f"{root}/in", _lines(9))
    assert main(["sensor", "--path", f"{root}/in", "--out", f"{root}/out", "--once"]) == 0
    assert spark.read.parquet(f"{root}/out/summary").count() == 9


def test_command_line_one_pass_once(spark):
    from pulseline.__main__ import main
    from pulseline.streaming import onepass as op
    root = scratch_path(spark, "test-cli")
    _write(spark, f"{root}/in", _lines(9) + [hr_line(value="x")])
    assert main(["sensor", "--path", f"{root}/in", "--out", f"{root}/out", "--once", "--one-pass"]) == 0
    assert op.summaries(spark, f"{root}/out").count() == 9 and op.dead_letters(spark, f"{root}/out").count() == 1


def test_command_line_words_once(spark):
    from pulseline.__main__ import main
    root = scratch_path(spark, "test-cli")
    for text in ("hello a b", "a hello"):
        _write(spark, f"{root}/in", [text])
    assert main(["words", "--path", f"{root}/in", "--out", f"{root}/out", "--once", "--show", "2"]) == 0
    got = {}
    for r in spark.read.parquet(f"{root}/out/words").collect():
        got.setdefault(r.word, []).append(r.n)
    assert {w: sorted(n) for w, n in got.items()} == {"hello": [2, 3], "a": [1, 2], "b": [1]}
    totals = sq.word_totals(spark, f"{root}/out")
    assert {r.word: r.n for r in totals.collect()} == {"hello": 3, "a": 2, "b": 1}


@pytest.fixture(scope="module")
def in_parts(spark):
    """The sf0.001 tables as four part files, their rows dealt at random."""
    folder = scratch_path(spark, "parts")
    for table in ("events", "documents"):
        (spark.read.parquet(f"{SF001}/{table}.parquet").repartition(4, F.rand(3))
         .write.parquet(f"{folder}/{table}.parquet"))
    return folder


@pytest.mark.parametrize("name", STREAM_PLANS)
def test_any_file_layout(spark, in_parts, name):
    assert compare(STREAM_PLANS[name](spark, in_parts), duck(SF001), SQL[name]) == []


def _fold_stream(spark, src, out, literal, buckets):
    stream = (spark.readStream.format("text").option("maxFilesPerTrigger", "1").load(src))
    df = sq.running_summary_stream(rec.trial_records(stream), literal=literal, buckets=buckets)
    sq.await_all([sq.sink(df, out, f"{out}_ckpt", available_now=True)])
    return sorted(tuple(r) for r in spark.read.parquet(out).collect())


def test_bucketed_folds_match_keyed(spark):
    """Keys sharing a bucket fold independently, across batches, for the
    running summary and the literal fold (new-key rows included)."""
    root = scratch_path(spark, "test")
    lines = _lines(30)
    for i in range(0, 30, 7):
        _write(spark, f"{root}/in", lines[i:i + 7])
    for literal in (False, True):
        keyed = _fold_stream(spark, f"{root}/in", f"{root}/k{literal}", literal, None)
        bucketed = _fold_stream(spark, f"{root}/in", f"{root}/b{literal}", literal, 2)
        assert len(keyed) == 30 and keyed == bucketed


def test_queries_on_a_time_trigger(spark):
    """Without ``available_now`` the queries go on from trigger to trigger."""
    root = scratch_path(spark, "test")
    _write(spark, f"{root}/in", _lines(6))
    stream = rec.trial_records(read_lines(spark, f"{root}/in", mode="stream"))
    qs = sq.start_sensor_queries(spark, stream, f"{root}/out", trigger="1 second")
    try:
        for _ in range(2):
            for q in qs.values():
                q.processAllAvailable()
            _write(spark, f"{root}/in", _lines(6, start=6))
    finally:
        for q in qs.values():
            q.stop()
    assert sq.records_seen(spark, f"{root}/out") == 12
    assert spark.read.parquet(f"{root}/out/summary").count() == 12

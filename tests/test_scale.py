"""Tasks, state calls and files stay bounded as tables grow."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from pulseline.session import scratch_path
from pulseline.sources.lines import ordered_slices
from pulseline.store.keyed import KeyedStore
from pulseline.streaming import ordered as od
from pulseline.streaming.processors import (
    PACKETS, BucketedRunningSummaryProcessor, BucketedWordCountProcessor, PacketState, running_batch,
    running_runs)


class FakeState:
    """A map or list state that counts its calls."""

    def __init__(self):
        self.map, self.list, self.calls = {}, [], 0

    def getValue(self, key):
        self.calls += 1
        return self.map.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value

    def exists(self):
        return bool(self.list)

    def get(self):
        return iter(self.list)

    def appendList(self, rows):
        self.calls += 1
        self.list += rows

    def put(self, rows):
        self.calls += 1
        self.list = list(rows)

    def clear(self):
        self.list = []


class FakeHandle:
    def __init__(self):
        self.states, self.timers = {}, []

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, FakeState())

    getListState = getMapState

    def registerTimer(self, at):
        self.timers.append(at)

    def calls(self):
        return sum(s.calls for s in self.states.values())


class Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def records(n_keys, start=0):
    return pd.DataFrame({
        "record_key": [f"k{i:05d}" for i in range(n_keys)], "trial_id": "t", "patient_id": None, "visit_name": "v",
        "value": np.arange(n_keys, dtype=np.int32) - 5, "start_ts": pd.Timestamp("2024-01-01"),
        "at": np.arange(n_keys) + start, "seq": pd.Series(range(n_keys), dtype="Int64")})


def test_a_slice_is_cut_into_many_files(spark):
    path = scratch_path(spark, "table")
    spark.range(0, 20_000, numPartitions=3).withColumn("v", F.col("id") % 5_000).write.parquet(path)
    slices = list(ordered_slices(spark.read.parquet(path), F.col("v"), 2, task_bytes=10_000))
    assert len(slices) == 2 and all(len(s.inputFiles()) > 2 for s in slices)
    (low, n0), (high, n1) = [(s.agg(F.min("v"), F.max("v")).first(), s.count()) for s in slices]
    assert low[1] < high[0] and n0 + n1 == 20_000


def test_packets_take_few_state_calls():
    handle = FakeHandle()
    state = PacketState(handle, "s")
    keys = [f"k{i}" for i in range(1000)] + ["é", "", None]
    assert state.load(keys) == [None] * len(keys)
    state.store(keys, [(i, None, "x") for i in range(len(keys))])
    assert state.load(keys[500:]) == [[i, None, "x"] for i in range(500, len(keys))]
    state.store(keys[:0], [])
    assert handle.calls() <= 4 * PACKETS


def test_runs_are_those_of_each_key():
    rng = np.random.default_rng(3)
    v = rng.integers(-9, 9, 200)
    starts = np.array([0, 1, 50, 51, 120])
    states = [None, [3, -7, -9, 2], None, [1, 4, 4, 4], [2, 0, -20, 20]]
    cols, new = running_runs(v, starts, states)
    for s, e, old, now in zip(starts, [1, 50, 51, 120, 200], states, new):
        *want, state = running_batch(v[s:e], old)
        assert now == state and all((c[s:e] == w).all() for c, w in zip(cols, want))


def test_a_batch_of_many_keys_takes_few_state_calls():
    for proc, rows in ((BucketedRunningSummaryProcessor(), records(2_000)),
                       (BucketedWordCountProcessor(), pd.DataFrame({
                           "doc_id": range(2_000), "pos": 0, "word": [f"w{i}" for i in range(2_000)]}))):
        handle = FakeHandle()
        proc.init(handle)
        for n in (1, 2):
            out = pd.concat(proc.handleInputRows((0,), iter([rows]), None))
            assert set(out["run_count" if "run_count" in out else "n"]) == {n}
        assert handle.calls() <= 4 * PACKETS


def test_waiting_records_lie_in_chunks():
    proc, handle = od.OrderBufferProcessor(), FakeHandle()
    proc.init(handle)
    rows = records(3_000)
    assert list(proc.handleInputRows((0,), iter([rows[::-1][:1_500], rows[:1_500]]), Clock(0))) == []
    assert len(handle.states["waiting_chunks"].list) == 1 and handle.timers == [1]
    out = pd.concat(proc.handleExpiredTimer((0,), Clock(2_000), None))
    assert out["record_key"].tolist() == rows["record_key"][:2_000].tolist()
    assert handle.timers == [1, 2_001] and out["seq"].tolist() == list(range(2_000))
    held = [pa.ipc.open_stream(c[0]).read_all() for c in handle.states["waiting_chunks"].list]
    assert sum(map(len, held)) == 1_000
    rest = pd.concat(proc.handleExpiredTimer((0,), Clock(9_000), None))
    assert len(rest) == 1_000 and not handle.states["waiting_chunks"].exists()
    assert handle.calls() <= 4 + 4 * PACKETS


def test_a_small_delta_is_written_by_many_tasks(spark):
    rows = spark.createDataFrame([(f"w{i}",) for i in range(500)], "word STRING")
    store = KeyedStore.create(spark, scratch_path(spark, "many"), rows, key="word", kind="counts", buckets=16)
    store.append(rows, 0)
    combined = store._combined(list(range(16)))
    assert combined.select(F.spark_partition_id()).distinct().count() > 4
    assert combined.count() == 500

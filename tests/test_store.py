"""The keyed upsert store: commits, repeats, losses, buckets rewritten."""

import pytest
from pyspark.sql import functions as F

from conftest import hr_line
from pulseline.operators import records as rec
from pulseline.operators.report import latest_by_key
from pulseline.operators.summary import summary
from pulseline.session import scratch_path
from pulseline.sources.lines import read_lines
from pulseline.store import keyed
from pulseline.store.keyed import Conflict, KeyedStore, feed


def lines(n, start=0, patients=40):
    return [hr_line(patient=f"{(i * 7) % patients:09d}", value=str(40 + i % 50), time=f"{i % 24:02d}0000",
                    seq=str(i)) for i in range(start, start + n)]


def records(spark, some):
    return rec.trial_records(spark.createDataFrame([(x,) for x in some], "value STRING"))


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


WANT = {"latest": latest_by_key, "totals": summary}


@pytest.mark.parametrize("kind", WANT)
def test_batches_give_the_view_of_all_records(spark, kind):
    batches = [lines(60), lines(50, 60), lines(40, 110, patients=3)]
    store = KeyedStore.create(spark, scratch_path(spark, "store"), records(spark, []), kind=kind, buckets=16)
    assert rows(store.read()) == []
    seen = []
    for i, b in enumerate(batches):
        seen += b
        assert store.append(records(spark, b), i)
        want = rows(WANT[kind](records(spark, seen)))
        assert rows(store.read()) == want  # with a pending delta
        if i != 1:
            store.merge()
            assert rows(store.read()) == want and not store.manifest.deltas
    again = KeyedStore.open(spark, store.path)
    assert rows(again.read()) == rows(WANT[kind](records(spark, seen)))


def test_merge_rewrites_touched_buckets_only(spark):
    store = KeyedStore.create(spark, scratch_path(spark, "store"), records(spark, []), buckets=16)
    store.append(records(spark, lines(200)), 0)
    store.merge()
    before = store.manifest.written
    one = [hr_line(patient="000000007", value="77", day="09JAN2024", seq="999")]
    store.append(records(spark, one), 1)
    touched = store.merge()
    after = store.manifest.written
    assert len(touched) == 1 and [b for b in range(16) if before[b] != after[b]] == touched
    assert store.merge() == [] and store.manifest.written == after
    got = store.get("TR-001_000000007_S01")
    assert [r.value for r in got.collect()] == [77]
    # only the bucket of the key is read
    assert len(got.inputFiles()) == 1


def test_a_loss_before_the_commit_changes_nothing(spark, monkeypatch):
    store = KeyedStore.create(spark, scratch_path(spark, "store"), records(spark, []), kind="totals", buckets=8)
    store.append(records(spark, lines(30)), 0)
    want = rows(store.read())

    def lost(self, m):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedStore, "_commit", lost)
        for write in (lambda: store.append(records(spark, lines(30, 30)), 1), store.merge):
            with pytest.raises(RuntimeError, match="lost"):
                write()
    store = KeyedStore.open(spark, store.path)
    assert rows(store.read()) == want and store.manifest.next_batch == 1
    # the restarted job offers its last batches again
    assert not store.append(records(spark, lines(30)), 0)
    assert store.append(records(spark, lines(30, 30)), 1)
    store.merge()
    assert rows(store.read()) == rows(summary(records(spark, lines(60))))
    assert store.vacuum() >= 2  # what was lost, and what was merged
    assert rows(KeyedStore.open(spark, store.path).read()) == rows(summary(records(spark, lines(60))))


def test_batches_in_order_and_one_writer(spark):
    store = KeyedStore.create(spark, scratch_path(spark, "store"), records(spark, []), buckets=4)
    with pytest.raises(ValueError, match="came before"):
        store.append(records(spark, lines(3)), 2)
    other = KeyedStore.open(spark, store.path)
    assert store.append(records(spark, lines(3)), 0)
    with pytest.raises(Conflict):
        other.append(records(spark, lines(3, 3)), 0)
    with pytest.raises(ValueError, match="there is a store"):
        KeyedStore.create(spark, store.path, records(spark, []))
    with pytest.raises(FileNotFoundError):
        KeyedStore.open(spark, scratch_path(spark, "none"))
    # a reader keeps the version that it opened
    old = KeyedStore.open(spark, store.path)
    assert store.append(records(spark, []), 1) and store.manifest.next_batch == 2
    store.append(records(spark, lines(9, 9)), 2)
    assert old.read().count() == 3 and KeyedStore.open(spark, store.path, old.manifest.version).read().count() == 3


def test_a_stream_feeds_the_store_once(spark, monkeypatch):
    root = scratch_path(spark, "feed")

    def arrive(some):
        spark.createDataFrame([(x,) for x in some], "value STRING").coalesce(1).write.mode("append").text(f"{root}/in")

    def stream():
        return rec.trial_records(read_lines(spark, f"{root}/in", mode="stream"))

    store = KeyedStore.create(spark, f"{root}/store", records(spark, []), kind="totals", buckets=8)
    arrive(lines(20))
    assert feed(store, stream(), f"{root}/ckpt")
    assert not feed(store, stream(), f"{root}/ckpt")
    arrive(lines(20, 20))
    with monkeypatch.context() as m:  # lost after the stream's batch, before the store's commit
        m.setattr(KeyedStore, "_commit", lambda self, m: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            feed(store, stream(), f"{root}/ckpt")
    arrive(lines(10, 40))
    store = KeyedStore.open(spark, store.path)
    assert feed(store, stream(), f"{root}/ckpt")
    store.merge()
    assert rows(store.read()) == rows(summary(records(spark, lines(50))))


def test_buckets_of_a_version_do_not_depend_on_partitions(spark):
    store = KeyedStore.create(spark, scratch_path(spark, "store"), records(spark, []), buckets=8)
    store.append(records(spark, lines(80)).repartition(7), 0)
    files = [f for f in store.read().inputFiles()]
    assert len(files) == len(store.manifest.touched())
    words = spark.createDataFrame([("a",), ("b",), ("a",)], "word STRING")
    counts = KeyedStore.create(spark, scratch_path(spark, "store"), words, key="word", kind="counts", buckets=4)
    assert counts.append(words, 0) and counts.append(words, 1)
    assert rows(counts.read()) == [(2, "b"), (4, "a")]
    assert {"counts", *WANT} == set(keyed.KINDS)
    assert store.read().where(F.col("record_key").isNull()).count() == 0

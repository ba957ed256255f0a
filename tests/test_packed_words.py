"""Disk of the word stream: tokens are packed for the shuffle, input goes when it is taken."""

import collections
import glob
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from test_scale import FakeHandle

from pulseline.operators import words
from pulseline.plans import streams
from pulseline.plans.catalog import PLANS
from pulseline.session import SHUFFLES_GO, scratch_path, settings
from pulseline.streaming import packed, processors
from pulseline.streaming import queries as sq

COLUMNS = ("doc_id", "pos", "word", "n")


def _table(rows, buckets):
    lists = [w for _, w in rows]
    return pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()),
                     words.WORDS: pa.array(lists, pa.list_(pa.string())),
                     packed.BUCKETS: pa.array([[hash(w) % buckets for w in x] for x in lists], pa.list_(pa.int32()))})


def _counted(batches, state=None):
    """Rows of all buckets of a batch of pieces, in the order that they come."""
    out, state = [], {} if state is None else state
    by = collections.defaultdict(list)
    for row in (r for b in batches for r in b.to_pylist()):
        by[row[packed.BUCKET]].append(row)
    for bucket, rows in by.items():
        proc = processors.PackedWordCountProcessor()
        proc.init(state.setdefault(bucket, FakeHandle()))
        for pdf in proc.handleInputRows((bucket,), iter([pd.DataFrame(rows)]), None):
            out += zip(*(pa.array(pdf[c], from_pandas=True).to_pylist() for c in COLUMNS))
    return out


def _want(rows, counts):
    order = sorted(((i is not None, i or 0, p, w, i) for i, x in rows for p, w in enumerate(x)), key=lambda t: t[:4])
    out = []
    for _, _, p, w, i in order:
        counts[w] += 1
        out.append((i, p, w, counts[w]))
    return out


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_packed_tokens_are_counted_as_a_loop_does(monkeypatch, buckets):
    """Also ids that repeat, are missing or far apart, texts without words,
    and a bucket that is counted in many ranges."""
    monkeypatch.setattr(processors, "RANGE_TOKENS", 40)
    monkeypatch.setattr(processors, "ROWS_OUT", 17)
    rng = random.Random(buckets)
    vocabulary = ["", "a", "b", "hello", "éé", "x" * 300] + [f"w{i}" for i in range(40)]
    state, counts = {}, collections.Counter()
    for _ in range(2):
        rows = [(rng.choice([None, -2 ** 63, 2 ** 63 - 1, 5, 5, rng.randrange(-99, 99)]),
                 [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40]))]) for _ in range(200)]
        pieces = [packed.pack_texts(_table(rows[i:i + 60], buckets), "doc_id") for i in range(0, 200, 60)]
        got = _counted(pieces, state)
        assert sorted(got, key=repr) == sorted(_want(rows, counts), key=repr)
    assert packed.pack_texts(_table([(1, []), (2, [])], buckets), "doc_id").num_rows == 0


def test_tokens_sort_the_same_with_numbers_that_do_not_fit_together():
    rng = np.random.default_rng(2)
    code, rank, pos = (rng.integers(0, 9, 500) for _ in range(3))
    small = processors._sorted_tokens(code, rank, pos)
    far = processors._sorted_tokens(code << 40, rank, pos << 20)
    assert all((a == b).all() for a, b in zip(small, (far[0] >> 40, far[1], far[2] >> 20)))


def test_batches_are_packed_in_parts_of_bounded_size(monkeypatch):
    monkeypatch.setattr(packed, "LEAST_BYTES", 2_000)
    monkeypatch.setattr(packed, "BYTES_A_BUCKET", 1)
    rows = [(i, ["a", "b", f"w{i}"]) for i in range(500)]
    batches = [b for b in _table(rows, 4).to_batches(max_chunksize=300)]
    pieces = list(packed.pack_batches("doc_id", 4)(iter(batches)))
    assert len(pieces) > 5
    assert sorted(_counted(pieces)) == sorted(_want(rows, collections.Counter()))


def _texts(spark, n=600, each=300):
    """Texts of many words, the first of them in most texts."""
    word = F.concat(F.lit("word"), F.floor(F.pow(F.rand(5), 3) * 4000).cast("int"))
    rows = spark.range(n * each, numPartitions=4).select((F.col("id") % n).alias("doc_id"), word.alias("w"))
    return rows.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("w")).alias("text"))


def test_tokens_move_in_a_few_bytes_each(spark):
    texts = _texts(spark)
    lists = words.tokenize(texts, lists=True).select("doc_id", words.WORDS, F.transform(
        words.WORDS, lambda w: sq.key_bucket(w, 16)).alias(packed.BUCKETS))
    rows = lists.coalesce(1).mapInArrow(packed.pack_batches("doc_id", 16), packed.PACKED_SCHEMA)
    size = rows.agg(F.sum(F.length("texts") + F.length("tokens"))).first()[0]
    assert size < 5 * 600 * 300  # a row of a token has some 20 in the shuffle, compressed


def test_what_the_word_stream_has_taken_goes(spark):
    folder = scratch_path(spark, "table")
    _texts(spark).repartition(3).write.parquet(f"{folder}/documents.parquet")
    result = streams.stream_word_count(spark, folder)
    assert result.count() == 600 * 300
    out = streams._words_run(spark, folder, False).removeprefix("file:")
    assert not glob.glob(f"{out}/input/**/*.parquet", recursive=True)
    log = glob.glob(f"{out}/words/*.parquet")
    columns = [pq.ParquetFile(f).metadata.row_group(0).column(i) for f in log for i in range(4)]
    assert {c.compression for c in columns} == {"ZSTD"}
    assert not any("DICTIONARY" in e for c in columns for e in c.encodings)
    want = PLANS["running_word_count"](spark, folder).select(*COLUMNS)
    assert result.exceptAll(want).isEmpty() and want.exceptAll(result).isEmpty()


def test_settings_hold_for_a_block_only(spark):
    name, unknown = next(iter(SHUFFLES_GO)), "pulseline.test.setting"
    was = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), settings(spark, SHUFFLES_GO | {unknown: "1"}):
        assert spark.conf.get(name) == "true" and spark.conf.get(unknown) == "1"
        1 / 0
    assert spark.conf.get(name) == was and spark.conf.get(unknown, None) is None

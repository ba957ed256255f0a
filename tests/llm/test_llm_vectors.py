"""Bit-sliced top-k and vector codes against plain loops."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF01
from pulseline.llm import bitsliced, codebooks
from pulseline.llm.bitsliced import OP11_SQL, Block, boundary, op11_exact_topk, places, search, slice_rows
from pulseline.llm.codebooks import (OP12_SQL, Codebook, books_text, compress_labelled, decode,
                                     op12_code_compression, train)

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, code string, error int"


def floats(x):
    return [float(np.float32(v)) for v in x]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


# --- top-k ----------------------------------------------------------------------

def brute_topk(rows, k=10):
    """rows: (vec_id, vector); a sorted list of result rows."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if usable(v)]
    out = []
    for a, (q, x) in enumerate(kept):
        if q is None or q % 100:
            continue
        found = sorted((-sum(s * t for s, t in zip(x, y)), c is None, c or 0)
                       for b, (c, y) in enumerate(kept) if b != a)[:k]
        out += [(q, r, None if null else c, -s) for r, (s, null, c) in enumerate(found, 1)]
    return sorted(out, key=repr)


def spark_topk(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x", 1) for i, v in rows], SCHEMA)
    got = search(df, "vec_id", "embedding", df["vec_id"] % 100 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_topk_sql(spark):
    assert not compare(op11_exact_topk(spark, SF01), duck(SF01), OP11_SQL)


def test_topk_nulls_ties_repeats_lengths(spark):
    r = random.Random(5)
    rows = [(i, floats(r.uniform(-1, 1) for _ in range(6))) for i in range(250)]
    rows += [(100, rows[100][1]), (100, rows[100][1]), (None, rows[7][1]), (None, rows[0][1])]
    rows += [(300, None), (400, [1.0, None, 0.0]), (500, [NAN] * 6), (600, [INF] + [0.0] * 5), (700, []),
             (800, [0.5]), (801, floats(r.uniform(-30, 30) for _ in range(6)))]
    rows += [(900 + i, [0.25] * 6) for i in range(120)]
    assert spark_topk(spark, rows) == brute_topk(rows)


def test_topk_fewer_rows_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert spark_topk(spark, rows) == brute_topk(rows)
    assert spark_topk(spark, [(0, [1.0])]) == []
    assert spark_topk(spark, []) == []
    assert spark_topk(spark, [(0, None), (None, None)]) == []


def test_topk_blocks_of_the_index_and_the_queries(spark, monkeypatch):
    """Many small blocks and all rows as queries give the same rows."""
    monkeypatch.setattr(bitsliced, "BLOCK", 37)
    monkeypatch.setattr(bitsliced, "QUERY_BLOCK", 5)
    r = random.Random(6)
    rows = [(100 * i, floats(r.gauss(0, 0.2) for _ in range(8))) for i in range(300)]
    assert spark_topk(spark, rows) == brute_topk(rows)


def test_topk_refuses_what_does_not_fit(spark):
    with pytest.raises(Exception, match="beyond 31 bits"):
        spark_topk(spark, [(0, [1e30]), (1, [1.0])])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 6), st.integers(0, 11), st.integers(0, 2 ** 31))
def test_slices_leave_no_better_row_out(n, dims, bits, seed):
    """The slices' sums differ from exact scores by at most the bound, and the
    boundary rows hold all of the k best."""
    r = np.random.default_rng(seed)
    most = 1 << bits
    rows = r.integers(-most, most + 1, (n, dims))
    weights = r.integers(-most, most + 1, dims)
    block = Block(rows, np.arange(n), np.zeros(n, bool), *slice_rows(rows))
    sums, slack = block.sums(weights)
    value = np.zeros(n, np.int64)
    for i, s in enumerate(sums):
        bit = np.zeros(n, bool)
        at = places(s)
        bit[at[at < n]] = True
        value += bit.astype(np.int64) << i
    drop = max(0, int(np.abs(weights).max()).bit_length() - bitsliced.DIGITS)
    off = rows @ weights - (value << drop)
    assert off.max() - off.min() <= slack << drop
    k = min(3, n)
    near = set(places(boundary(sums, block.all, k, slack)).tolist())
    score = rows @ weights
    assert near >= set(np.flatnonzero(score > np.sort(score)[-k]).tolist())
    found, got = block.best(weights, k, None)
    assert [(-s, f) for s, f in zip(got, found)] == sorted((-s, i) for i, s in enumerate(score))[:k]


# --- vector codes -----------------------------------------------------------------

def brute_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label); result rows as a sorted list."""
    kept = [(i, [math.floor(4096 * x) for x in v], c) for i, v, c in rows if usable(v) and v]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [nearest(book, x[p])[1] for x in cut]
            for e in range(len(book)):
                own = [x[p] for x, k in zip(cut, of) if k == e]
                if own:
                    book[e] = [sum(c) // len(own) for c in zip(*own)]
    found = [[nearest(book, x[p]) for p, book in enumerate(books)] for x in cut]
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, c), e in zip(kept, errors):
        total[c] = total.get(c, 0) + e
    import hashlib
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, total[c], digest)
                   for (i, _, c), f, e in zip(kept, found, errors)), key=repr)


def spark_codes(spark, rows):
    df = spark.createDataFrame([(i, v, c, "x", "x", "x", 1) for i, v, c in rows], SCHEMA)
    got = compress_labelled(df, "vec_id", "embedding", "label")
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_codes_sql(spark):
    assert not compare(op12_code_compression(spark, SF01), duck(SF01), OP12_SQL)


def test_codes_nulls_ties_repeats(spark):
    r = random.Random(7)
    rows = [(i, floats(r.gauss(0, 0.3) for _ in range(16)), r.choice([None, 1, 1, 2])) for i in range(90)]
    rows += [(3, rows[3][1], 1), (3, floats([0.1] * 16), None), (None, rows[9][1], 4), (5, rows[9][1], None)]
    rows += [(-5, None, 1), (-6, [NAN] * 16, 1), (-7, [None] + [0.0] * 15, 2), (-8, [-INF] * 16, 2), (-9, [], 3)]
    rows += [(1000 + i, floats([0.5] * 16), 9) for i in range(40)]
    assert spark_codes(spark, rows) == brute_codes(rows)


def test_codes_few_rows_and_none(spark):
    rows = [(2, [0.5] * 8, None), (1, [-0.25] * 8, None), (1, [-0.25] * 8, 3)]
    assert spark_codes(spark, rows) == brute_codes(rows)
    assert spark_codes(spark, []) == []
    assert spark_codes(spark, [(1, None, 1), (2, [], 1)]) == []


def test_codes_of_many_labels_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "FEW_LABELS", 2)
    r = random.Random(8)
    rows = [(i, floats(r.gauss(0, 1) for _ in range(8)), i % 7 or None) for i in range(60)]
    assert spark_codes(spark, rows) == brute_codes(rows)


def test_codes_refuse_mixed_lengths(spark):
    with pytest.raises(Exception, match="are needed"):
        spark_codes(spark, [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)])
    with pytest.raises(Exception, match="are needed"):
        spark_codes(spark, [(1, [0.5] * 7, 1)])


def test_codes_stand_for_their_entries(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    books = train(df, "vec_id", "embedding", rounds=2)
    got = codebooks.compress(df, "vec_id", "embedding", books).orderBy("id").collect()
    rows = df.orderBy("vec_id").select(F.transform("embedding", lambda x: F.floor(
        x.cast("double") * 4096)).alias("v")).collect()
    back = decode([r.code for r in got], books)
    assert [r.error for r in got] == ((np.array([r.v for r in rows]) - back) ** 2).sum(axis=1).tolist()
    assert len(books_text(books).split(",")) == 16 * 64


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 16), st.integers(1, 5), st.integers(1, 40), st.integers(0, 2 ** 31))
def test_equal_average_search_is_exact(entries, size, most, seed):
    r = np.random.default_rng(seed)
    book = r.integers(-most, most + 1, (entries, size))
    parts = r.integers(-most, most + 1, (50, size))
    at, best = Codebook(book).nearest(parts)
    d = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert best.tolist() == d.min(axis=1).tolist() and at.tolist() == d.argmin(axis=1).tolist()

"""The streaming folds, batch by batch with carried state, against the
record-by-record definitions (pure numpy, no Spark)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from test_compat import literal_fold

from pulseline.streaming.processors import literal_fold_batch, running_batch

values = st.lists(st.integers(min_value=-50, max_value=400), min_size=1, max_size=40)
cuts = st.lists(st.integers(min_value=1, max_value=40), max_size=6)


def _batches(vals, cut_points):
    pts = sorted({c for c in cut_points if c < len(vals)})
    edges = [0, *pts, len(vals)]
    return [np.array(vals[a:b], dtype=np.int64) for a, b in zip(edges, edges[1:])]


@settings(max_examples=300, deadline=None)
@given(values, cuts)
def test_literal_fold_over_batches(vals, cut_points):
    got, state = [], None
    for b in _batches(vals, cut_points):
        mx, mn, cnt, tot, state = literal_fold_batch(b, state)
        got += list(zip(mx.tolist(), mn.tolist(), cnt.tolist(), tot.tolist()))
    assert got == literal_fold(vals)


@settings(max_examples=300, deadline=None)
@given(values, cuts)
def test_running_over_batches(vals, cut_points):
    got, state = [], None
    for b in _batches(vals, cut_points):
        cnt, tot, mn, mx, state = running_batch(b, state)
        got += list(zip(cnt.tolist(), tot.tolist(), mn.tolist(), mx.tolist()))
    want = [(i + 1, sum(vals[:i + 1]), min(vals[:i + 1]), max(vals[:i + 1]))
            for i in range(len(vals))]
    assert got == want

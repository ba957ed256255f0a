"""Every registered plan against its DuckDB oracle (sf0.01 for batch plans,
sf0.001 for the streaming runs)."""

import pytest

from conftest import SF001, SF01
from compare import compare, duck

import __spark_entry__ as E
from pulseline.plans.catalog import PLANS
from pulseline.plans.stores import STORE_PLANS
from pulseline.plans.streams import STREAM_PLANS

Q = {**PLANS, **STORE_PLANS, **STREAM_PLANS}
O = {k: E.oracle_sql()[k] for k in Q}
BATCH = [k for k in Q if not k.startswith("stream_")]
STREAM = [k for k in Q if k.startswith("stream_")]


@pytest.fixture(scope="module")
def con01():
    return duck(SF01)


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


def test_every_plan_is_registered():
    assert set(Q) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", BATCH)
def test_batch_plan(spark, con01, name):
    assert compare(Q[name](spark, SF01), con01, O[name]) == []


@pytest.mark.parametrize("name", STREAM)
def test_stream_plan(spark, con001, name):
    assert compare(Q[name](spark, SF001), con001, O[name]) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "n_records" in df.columns


@pytest.mark.parametrize("width", [3600, 86400])
def test_running_plans_with_forced_small_chunks(spark, con01, width):
    """Registered plans size chunks from the data (one chunk at this scale);
    force small chunks so the cross-chunk combination meets the oracle."""
    from pulseline.operators.compat import compat_running
    from pulseline.operators.summary import running_summary
    from pulseline.operators import words
    from pulseline.plans.catalog import _records
    r = _records(spark, SF01)
    assert compare(running_summary(r, chunk_seconds=width), con01, O["running_summary"]) == []
    assert compare(compat_running(r, chunk_seconds=width), con01, O["compat_running"]) == []
    docs = words.with_text_chunk(spark.read.parquet(f"{SF01}/documents.parquet"), texts_per_chunk=width // 3600)
    tokens = words.tokenize(docs, carry=(words.CHUNK,))
    assert compare(words.running_word_count(tokens), con01, O["running_word_count"]) == []

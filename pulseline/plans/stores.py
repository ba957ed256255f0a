"""Named plans over the stores: a table's records or lines arrive in batches,
and views, reports and searches are answered by the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.operators import records as rec
from pulseline.session import scratch_path
from pulseline.sources.lines import load_event_lines, ordered_slices, render_event_lines
from pulseline.store.keyed import KeyedStore
from pulseline.store.rollups import SummaryStore
from pulseline.store.search import LineIndex

BATCHES = 3


def record_batches(spark: SparkSession, sf_dir: str, n: int = BATCHES) -> list[DataFrame]:
    """Keyed records in consecutive ranges of their time."""
    records = rec.trial_records(load_event_lines(spark, sf_dir))
    return list(ordered_slices(records, F.col("start_ts"), n))


def _filled(spark: SparkSession, sf_dir: str, kind: str) -> KeyedStore:
    batches = record_batches(spark, sf_dir)
    empty = rec.trial_records(load_event_lines(spark, sf_dir)).limit(0)
    store = KeyedStore.create(spark, scratch_path(spark, f"store-{kind}"), empty, kind=kind)
    for i, rows in enumerate(batches):
        store.append(rows, i)
        if i + 1 < len(batches):  # the last one is combined by the reader
            store.merge()
    return store


def store_latest_by_key(spark, sf_dir):
    """The latest record per key, as a keyed upsert leaves it."""
    return _filled(spark, sf_dir, "latest").read()


def store_summary_by_key(spark, sf_dir):
    """Totals per key, kept up to date batch by batch."""
    return _filled(spark, sf_dir, "totals").read()


GROUPINGS = (("trial_id", "patient_id", "visit_name", "device"), ("trial_id", "visit_name", "device"),
             ("patient_id",), ("trial_id", "device"))


def _summaries(spark: SparkSession, sf_dir: str) -> SummaryStore:
    store = SummaryStore(spark, scratch_path(spark, "summaries"), GROUPINGS)
    for i, rows in enumerate(record_batches(spark, sf_dir)):
        store.append(rows, i)
    return store


def rollup_patient_report(spark, sf_dir):
    """The patient report from stored partial summaries."""
    return _summaries(spark, sf_dir).report(("patient_id",))


def rollup_report_by_visit(spark, sf_dir):
    return _summaries(spark, sf_dir).report(("trial_id", "visit_name", "device"))


def rollup_filtered_report(spark, sf_dir):
    """Devices of one trial and two visits, from the smallest summary that has the columns."""
    return _summaries(spark, sf_dir).report(("device",), {"trial_id": "TR-001", "visit_name": ["S01", "S03"]})


def search_lines(spark, sf_dir):
    """Lines of a trial's women with a daily mean heart rate, by the index."""
    index = LineIndex(spark, scratch_path(spark, "index"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i, rows in enumerate(ordered_slices(events, F.col("ts"), BATCHES)):
        index.append(render_event_lines(rows), i)
    return index.search("DAILY", "MEAN", "0=TR-001", "3=F").select("line")


STORE_PLANS = {
    "rollup_patient_report": rollup_patient_report,
    "rollup_report_by_visit": rollup_report_by_visit,
    "rollup_filtered_report": rollup_filtered_report,
    "search_lines": search_lines,
    "store_latest_by_key": store_latest_by_key,
    "store_summary_by_key": store_summary_by_key,
}

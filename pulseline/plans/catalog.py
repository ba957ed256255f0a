"""Named batch plans over the driver tables.

Each plan takes ``(spark, sf_dir)`` and returns a DataFrame; nothing is
collected.  Sensor plans read ``events`` rendered as device lines (a narrow
projection of the table), so their work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.operators import compat
from pulseline.operators import reconcile as rc
from pulseline.operators import records as rec
from pulseline.operators import report as rep
from pulseline.operators import summary as summ
from pulseline.operators import words
from pulseline.sources.lines import LINE_FAULTS, load_event_lines
from pulseline.sources.sinks import to_documents


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_event_lines(spark, sf_dir)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.trial_records(_lines(spark, sf_dir))


def filter_lines(spark, sf_dir):
    return rec.filter_lines(_lines(spark, sf_dir)).select(F.col("value").alias("line"))


def trial_records(spark, sf_dir):
    return _records(spark, sf_dir)


def summary_by_key(spark, sf_dir):
    return summ.summary(_records(spark, sf_dir))


def summary_by_device_key(spark, sf_dir):
    """Summary under the per-device key variant (trial_patient_visit_device)."""
    recs = rec.trial_records(_lines(spark, sf_dir),
                             key_cols=("trial_id", "patient_id", "visit_name", "device"))
    return summ.summary(recs)


def patient_report(spark, sf_dir):
    return rep.patient_report(_records(spark, sf_dir))


def report_by_visit(spark, sf_dir):
    return rep.report(_records(spark, sf_dir), group_by=("trial_id", "visit_name", "device"))


def latest_by_key(spark, sf_dir):
    return rep.latest_by_key(_records(spark, sf_dir))


def running_summary(spark, sf_dir):
    return summ.running_summary(_records(spark, sf_dir))


def summary_by_patient(spark, sf_dir):
    """Summary under a key that is coarser than the identity."""
    recs = rec.trial_records(_lines(spark, sf_dir), key_cols=("patient_id",))
    return summ.summary(recs)


def merge_summaries(spark, sf_dir):
    """Partial summaries of morning and other observations, from one pass,
    merged."""
    r = _records(spark, sf_dir).withColumn(
        "morning", F.coalesce(F.hour("start_ts") < 12, F.lit(False)))
    return summ.merge_summaries(summ.partial_summary(r, by=("morning",)))


def record_count(spark, sf_dir):
    return summ.record_count(_records(spark, sf_dir))


def documents_json(spark, sf_dir):
    """Every keyed record as a JSON document with its id."""
    return to_documents(_records(spark, sf_dir))


def rejects(spark, sf_dir):
    """Every rendered line that does not parse (no category filter)."""
    return rec.rejects(_lines(spark, sf_dir))


def rejects_all_reasons(spark, sf_dir):
    """Lines rendered with faults of every kind, by event number."""
    return rec.rejects(load_event_lines(spark, sf_dir, faults=LINE_FAULTS))


def running_summary_with_faults(spark, sf_dir):
    """Running summaries of lines of which some have faults: bad lines are
    left out and the others are not touched by them."""
    lines = load_event_lines(spark, sf_dir, faults=LINE_FAULTS)
    return summ.running_summary(rec.trial_records(lines))


def alerts(spark, sf_dir):
    return rep.flag_alerts(_records(spark, sf_dir)).select(
        "record_key", "start_ts", "seq", "value", "variance", "alert")


def compat_running(spark, sf_dir):
    return compat.compat_running(_records(spark, sf_dir))


def compat_latest(spark, sf_dir):
    return compat.compat_latest(_records(spark, sf_dir))


def _tokens(spark, sf_dir):
    return words.tokenize(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def word_totals(spark, sf_dir):
    return words.word_totals(_tokens(spark, sf_dir))


def running_word_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chunked = words.with_text_chunk(docs, texts_per_chunk=words.texts_per_chunk(docs))
    return words.running_word_count(words.tokenize(chunked, carry=(words.CHUNK,), lists=True))


def order_parts(spark, sf_dir):
    """Orders as competing parts: target = customer and priority, the order
    key is both source and rank, the status is the content."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(
        F.concat_ws("_", F.col("o_custkey").cast("string"), F.col("o_orderpriority"))
        .alias("target"),
        F.col("o_orderkey").cast("string").alias("source"),
        F.col("o_orderkey").alias("source_rank"),
        F.col("o_orderstatus").alias("content"))


def reconcile_first(spark, sf_dir):
    return rc.resolve_first(order_parts(spark, sf_dir))


def reconcile_last(spark, sf_dir):
    return rc.resolve_last(order_parts(spark, sf_dir))


def reconcile_single(spark, sf_dir):
    return rc.resolve_single_or_error(order_parts(spark, sf_dir))[0]


def reconcile_single_conflicts(spark, sf_dir):
    return rc.resolve_single_or_error(order_parts(spark, sf_dir))[1]


def reconcile_dedup(spark, sf_dir):
    return rc.resolve_deduplicate(order_parts(spark, sf_dir))[0]


def reconcile_dedup_conflicts(spark, sf_dir):
    return rc.resolve_deduplicate(order_parts(spark, sf_dir))[1]


def reconcile_concat(spark, sf_dir):
    return rc.resolve_concat(order_parts(spark, sf_dir))


def reconcile_distinct_lines(spark, sf_dir):
    return rc.resolve_distinct_lines(order_parts(spark, sf_dir))


def reconcile_rename(spark, sf_dir):
    return rc.resolve_rename(order_parts(spark, sf_dir))


# Fixed example rule list: priority suffix -> strategy, first match wins.
ORDER_RULES = [
    ("_1-URGENT$", rc.CONCAT),
    ("_2-HIGH$", rc.FIRST),
    ("_3-MEDIUM$", rc.LAST),
    ("_4-NOT SPECIFIED$", rc.FILTER_DISTINCT_LINES),
    ("_5-LOW$", rc.DISCARD),
]


def reconcile_by_rule(spark, sf_dir):
    return rc.reconcile(order_parts(spark, sf_dir), ORDER_RULES).resolved


def reconcile_counts(spark, sf_dir):
    return rc.reconcile(order_parts(spark, sf_dir), ORDER_RULES).counts


def document_parts(spark, sf_dir):
    """Documents as parts of several lines: few targets with an extension."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(
        F.concat(F.lit("texts/"), F.col("lang"), (F.col("doc_id") % 40).cast("string"), F.lit(".txt"))
        .alias("target"), F.concat(F.col("source"), F.lit(".jar")).alias("source"),
        F.col("doc_id").alias("source_rank"), F.col("text").alias("content"))


# Fixed example rule list for document parts.
DOCUMENT_RULES = [
    ("/en", rc.FILTER_DISTINCT_LINES),
    ("/fr[0-9]*[.]txt$", rc.RENAME),
    ("/fr", rc.LAST),
    ("/de", rc.CONCAT),
]


def reconcile_documents(spark, sf_dir):
    """Texts of many lines; renamed parts of one source meet again under
    their new target and are resolved by its rule."""
    return rc.reconcile(document_parts(spark, sf_dir), DOCUMENT_RULES).resolved


def reconcile_documents_conflicts(spark, sf_dir):
    return rc.reconcile(document_parts(spark, sf_dir), DOCUMENT_RULES).conflicts


def reconcile_documents_counts(spark, sf_dir):
    return rc.reconcile(document_parts(spark, sf_dir), DOCUMENT_RULES).counts


def reconcile_documents_conflict_sources(spark, sf_dir):
    """Every source behind a conflict, a row each."""
    parts = document_parts(spark, sf_dir)
    return rc.conflict_sources(parts, rc.reconcile(parts, DOCUMENT_RULES).conflicts)


PIECE_BYTES = 1 << 16


def reconcile_merged_pieces(spark, sf_dir):
    """The merged targets of the document parts, in pieces."""
    pieces = rc.merged_pieces(reconcile_documents(spark, sf_dir), PIECE_BYTES)
    return pieces.select("target", "piece", "offset", F.octet_length("content").cast("bigint").alias("n_bytes"),
                         F.sha2("content", 256).alias("content_sha256"))


def line_counts(spark, sf_dir):
    """Lines read, kept and rejected by reason, counted in the pass that
    parses and writes them."""
    return rec.parse_counted(load_event_lines(spark, sf_dir, faults=LINE_FAULTS))[2]


def rejects_counted(spark, sf_dir):
    """The rejects that the same pass has written."""
    return rec.parse_counted(load_event_lines(spark, sf_dir, faults=LINE_FAULTS))[1]


PLANS = {
    "reconcile_documents_conflict_sources": reconcile_documents_conflict_sources,
    "reconcile_merged_pieces": reconcile_merged_pieces,
    "line_counts": line_counts,
    "rejects_counted": rejects_counted,
    "filter_lines": filter_lines,
    "trial_records": trial_records,
    "summary_by_key": summary_by_key,
    "summary_by_device_key": summary_by_device_key,
    "summary_by_patient": summary_by_patient,
    "patient_report": patient_report,
    "report_by_visit": report_by_visit,
    "latest_by_key": latest_by_key,
    "running_summary": running_summary,
    "merge_summaries": merge_summaries,
    "record_count": record_count,
    "rejects": rejects,
    "rejects_all_reasons": rejects_all_reasons,
    "running_summary_with_faults": running_summary_with_faults,
    "documents_json": documents_json,
    "alerts": alerts,
    "compat_running": compat_running,
    "compat_latest": compat_latest,
    "word_totals": word_totals,
    "running_word_count": running_word_count,
    "reconcile_first": reconcile_first,
    "reconcile_last": reconcile_last,
    "reconcile_single": reconcile_single,
    "reconcile_single_conflicts": reconcile_single_conflicts,
    "reconcile_dedup": reconcile_dedup,
    "reconcile_dedup_conflicts": reconcile_dedup_conflicts,
    "reconcile_concat": reconcile_concat,
    "reconcile_distinct_lines": reconcile_distinct_lines,
    "reconcile_rename": reconcile_rename,
    "reconcile_by_rule": reconcile_by_rule,
    "reconcile_counts": reconcile_counts,
    "reconcile_documents": reconcile_documents,
    "reconcile_documents_conflicts": reconcile_documents_conflicts,
    "reconcile_documents_counts": reconcile_documents_counts,
}

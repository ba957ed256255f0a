"""Reports from stored summaries, and search by the inverted index."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import hr_line
from pulseline.operators import records as rec
from pulseline.operators.report import report
from pulseline.session import scratch_path
from pulseline.store.rollups import SummaryStore
from pulseline.store.search import LineIndex, has_terms


def lines(n, start=0):
    return [hr_line(trial=f"TR-00{i % 2}", patient=f"{i % 7:09d}", visit=f"S0{i % 3}", value=str(40 + (i * 37) % 60),
                    day=f"{1 + i // 24:02d}JAN2024", time=f"{i % 24:02d}0000", seq=str(i)) for i in range(start, start + n)]


def frame(spark, some):
    return spark.createDataFrame([(x,) for x in some], "value STRING")


def records(spark, some):
    return rec.trial_records(frame(spark, some))


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


GROUPINGS = (("trial_id", "patient_id", "visit_name"), ("patient_id",), ("trial_id", "visit_name"), ())


def test_reports_come_from_the_smallest_summary(spark):
    path = scratch_path(spark, "summaries")
    store = SummaryStore(spark, path, GROUPINGS)
    parts = [lines(60), lines(50, 60), lines(1, 110)]
    for i, some in enumerate(parts):
        store.append(records(spark, some), i)
    store.append(records(spark, parts[1]), 1)  # the job is repeated
    whole = records(spark, sum(parts, []))
    for group_by, filters, expected in (
            (("patient_id",), None, ("patient_id",)),
            (("visit_name",), {"trial_id": "TR-001"}, ("trial_id", "visit_name")),
            (("trial_id",), {"visit_name": ["S00", "S02"]}, ("trial_id", "visit_name")),
            (("patient_id", "visit_name"), None, ("patient_id", "trial_id", "visit_name")),
            ((), None, ()), (("patient_id",), {"patient_id": "nobody"}, ("patient_id",))):
        assert store.choose({*group_by, *(filters or {})}) == expected
        got = store.report(group_by, filters)
        assert rows(got) == rows(report(whole, group_by, filters))
        # no record is read: every file is one of the chosen summary
        folder = f"{path}/{'+'.join(expected) or 'all'}/"
        assert got.inputFiles() and all(folder in f for f in got.inputFiles())
    with pytest.raises(ValueError, match="no summary"):
        store.report(("device",))
    assert rows(store.report(("device",), None, whole)) == rows(report(whole, ("device",)))
    with pytest.raises(ValueError, match="one grouping"):
        SummaryStore(spark, path, (("patient_id",), ("device",)))


def test_search_reads_segments_with_hits_only(spark):
    index = LineIndex(spark, scratch_path(spark, "index"), buckets=8)
    some = lines(90) + ["", "words apart|TR-000", "TR-0001|x", None]
    index.append(frame(spark, some[:50]).repartition(3), 0)
    index.append(frame(spark, some[50:]).coalesce(2), 1)
    index.append(frame(spark, [hr_line(patient="987654321", value="77")]), 2)
    index.append(frame(spark, some[50:]).coalesce(2), 1)  # the job is repeated
    all_lines = frame(spark, [*some, hr_line(patient="987654321", value="77")])
    for terms in (("DAILY",), ("DAILY", "1=000000003"), ("TR",), ("000",), ("0=TR-000", "4=S02", "12=40"),
                  ("words", "apart"), ("987654321",), ("no", "DAILY"), ("0=TR",), ("DAILY", "DAILY")):
        got = sorted(r.line for r in index.search(*terms).collect())
        want = sorted(r.value for r in all_lines.where(has_terms(F.col("value"), terms)).collect())
        assert got == want, terms
    one = index.search("987654321")
    read = [f for f in one.inputFiles() if "/lines/" in f]
    assert len(read) == 1 and "batch=2" in read[0]
    with pytest.raises(ValueError, match="needs a term"):
        index.search()


def test_a_term_of_every_line_is_split_by_segments(spark):
    index = LineIndex(spark, scratch_path(spark, "index"))
    index.append(frame(spark, lines(400)).repartition(8), 0)
    lists = index.hits("MEASUREMENT").collect()
    assert len(lists) == 8 and sum(len(r.rows) for r in lists) == 400
    assert all(r.rows == sorted(set(r.rows)) for r in lists)


def test_an_index_shuffles_lists_and_not_terms(spark, monkeypatch):
    """Postings come as a list for each term and segment of a task, some in
    pieces, and are computed once."""
    from pulseline.store import search
    some = [f"common {i}|k{i % 3}" for i in range(300)] + [None, "", "common common|k1"]
    index = LineIndex(spark, scratch_path(spark, "index"), buckets=4)
    index.append(frame(spark, some).coalesce(1), 0)
    kept = spark.read.parquet(f"{index.path}/postings").where("term = 'common'").collect()
    assert len(kept) == 1 and len(kept[0].rows) == 301
    texts = ["x|y", "", "é9a|a9", "a a|b-a|", "|A_1|x", "=|1=x", "x\U0001f600y|\n\t", "||", "x"]
    lines = spark.createDataFrame([(s, r, x) for s in (3, 1) for r, x in enumerate(texts)],
                                  "seg INT, row INT, line STRING").withColumn("fields", search.split_fields(F.col("line")))
    monkeypatch.setattr(search, "PIECE_BYTES", 20)
    pieces = list(search.postings_of(iter(lines.toArrow().combine_chunks().to_batches(max_chunksize=2))))
    got = [(r["term"], r["seg"], r["rows"]) for p in pieces for r in p.to_pylist()]
    want = lines.select(F.explode(search.terms_of(F.col("line"))).alias("term"), "seg", "row").collect()
    assert len(pieces) > 2 and len(got) < len(want)
    assert sorted((t, s, r) for t, s, rows in got for r in rows) == sorted(map(tuple, want))
    raw = pa.array([b"a\xe9b|\xff", b"c"]).view(pa.string())
    assert search._tokens(raw[0:])[0].to_pylist() == ["a", "b", "c"]
    for size in (0, 3 << 20, 1 << 30):  # every bucket's postings have a task of their own, or a share of one
        tasks, task = index._tasks(size)
        used = spark.range(2_000).select(F.col("id").cast("string").alias("term"), F.lit(0).alias("seg")).withColumn(
            "bucket", index._bucket(F.col("term"))).select("bucket", task.alias("t")).distinct().collect()
        assert {r.t for r in used} == set(range(tasks))
        assert tasks <= 4 or len({r.t for r in used}) == len(used)

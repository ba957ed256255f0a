"""Nulls, empty and long texts, repeated rows, empty tables and extra columns
with the names of results, for every operator."""

import pytest
from pyspark.sql import functions as F

import brute
from pulseline.llm.fmindex import decontaminate, scan_benchmark
from pulseline.llm.langid import fit, identify
from pulseline.llm.licenses import scan_licenses
from pulseline.llm.linedup import dedup_lines
from pulseline.llm.pieces import encode_texts
from pulseline.llm.pst import score_texts
from pulseline.llm.quality import keep_good, quality_verdicts
from pulseline.llm.secrets import scan_secrets
from pulseline.llm.simhash import keep_first, near_duplicates

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words long, score string, spans int, fp string, kept string, h string, x int")
LONG = " ".join(f"w{i % 977} über" for i in range(30_000)) + "\n" + "a" * 50_000


def row(doc, text, lang="en", source="s"):
    return (doc, text, lang, source, None, 1, "clash", 2, "clash", "clash", "clash", 3)


ROWS = [row(1, None), row(2, ""), row(3, " \t\n "), row(4, "one"), row(4, "one"), row(5, "two words"),
        row(6, "same line of words\nsame line of words"), row(None, "a text without an id", None, None),
        row(7, LONG), row(8, LONG, "de"), row(9, "token = abcdefgh CC BY 4", "fr", "s2"),
        row(10, "\x00 nul 漢字 😀 é"), row(None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "two words"), (1, "two words"), (2, None), (3, ""), (None, "one")],
                                 "item_id long, text string")


def by_text(result, docs):
    """Results of ids that are not repeated."""
    return {r.doc_id: r for r in result if r.doc_id not in (None, 4)}


TEXTS = {r[0]: r[1] for r in ROWS if r[0] not in (None, 4)}


def test_secrets(docs):
    got = scan_secrets(docs).collect()
    assert len(got) == len(ROWS)
    for doc, r in by_text(got, docs).items():
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == brute.secrets(TEXTS[doc])


def test_licenses(docs):
    got = scan_licenses(docs).collect()
    assert len(got) == len(ROWS)
    for doc, r in by_text(got, docs).items():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.phrases(TEXTS[doc])
    assert sum(r.doc_id == 4 for r in got) == 2
    assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0}


def test_lm_scoring(docs):
    held = F.coalesce(F.col("doc_id") == 9, F.lit(False))
    got = score_texts(docs, held).collect()
    assert len(got) == len(ROWS)
    expected, n = brute.base_scores([r[1] for r in ROWS], [r[0] == 9 for r in ROWS])
    want = {r[0]: e for r, e in zip(ROWS, expected)}
    for doc, r in by_text(got, docs).items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (*want[doc][:2], n)
        assert r.base_score == pytest.approx(want[doc][2])
        assert r.score <= 0


def test_lines(docs):
    got = dedup_lines(docs.withColumn("lines", F.lit(1)).withColumn("n", F.lit(2)),
                      removed_col="gone").collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: r.text for r in got}[1] is None
    assert all(r.text == t for r in got for d, t in TEXTS.items() if r.doc_id == d)
    assert got[0].asDict().keys() == {*docs.columns, "lines", "n", "gone"}


def test_pieces(docs):
    got = encode_texts(docs.withColumn("parity", F.lit("x"))).collect()
    assert len(got) == len(ROWS)
    assert all(r.parity and r.round_trip and r.decoded == (r.text or "") for r in got)
    assert all(r.n_tokens == 0 and r.input_ids == [] for r in got if not r.text)


def test_languages(docs):
    got = identify(docs, fit(docs)).collect()
    assert len(got) == len(ROWS)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in got} <= {"und", "en", "de", "fr"}
    nothing = identify(docs, fit(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_simhash(docs):
    got = near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    for doc, r in by_text(got, docs).items():
        assert r.fingerprint == f"{brute.simhash(TEXTS[doc]):016x}"
    of = {r.doc_id: r.component_id for r in got}
    assert of[1] == of[2] == of[3] == 1 and of[7] == of[8] == 7
    kept = keep_first(docs).collect()
    assert {r.doc_id for r in kept} >= {1, 4, 5, 6, 7, 9, 10} and not {2, 3, 8} & {r.doc_id for r in kept}


def test_quality(docs):
    got = quality_verdicts(docs).collect()
    assert len(got) == len(ROWS)
    for doc, r in by_text(got, docs).items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == brute.quality(TEXTS[doc])
        assert not (r.base_failed and r.kept)
    assert keep_good(docs).columns == docs.columns


def test_decontamination(docs, bench):
    known = brute.windows([(1, "two words"), ("", "one")])
    got = scan_benchmark(docs.select("doc_id", "text", "score"), bench).collect()
    assert len(got) == len(ROWS)
    for doc, r in by_text(got, docs).items():
        n, hit, items, _, _ = brute.contamination(TEXTS[doc], known)
        assert (r._n_words, sum(r._ends) - sum(r._starts), len(r._items)) == (n, hit, items)
    left = decontaminate(docs.withColumn("_items", F.lit("x")), bench).collect()
    assert left[0].asDict().keys() == {*docs.columns, "_items"} and not {4, 5} & {r.doc_id for r in left}


@pytest.mark.parametrize("run", [
    scan_secrets, scan_licenses, dedup_lines, encode_texts, near_duplicates, keep_first,
    quality_verdicts, keep_good], ids=lambda f: f.__name__)
def test_empty_table(docs, run):
    assert run(docs.limit(0)).collect() == []


def test_empty_tables_with_parameters(docs, bench):
    none = docs.limit(0)
    assert score_texts(none, F.lit(False)).collect() == []
    assert identify(none, fit(none)).collect() == []
    assert decontaminate(none, bench).collect() == []
    assert all(r._starts == [] for r in scan_benchmark(docs.select("doc_id", "text"), bench.limit(0)).collect())


def test_no_training_rows(docs):
    got = score_texts(docs.where("doc_id = 5"), F.lit(True)).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score) == (3, 0, 0, 0.0)
    assert got.score == pytest.approx(-10 * 2.40824, abs=1e-3)

"""Cross-tokenizer alignment against plain loops over tokens."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from pulseline.llm import alignment
from pulseline.llm.alignment import A_PATH, B_PATH, align_texts, byte_letters, op13_tokenizer_alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    letter = byte_letters()

    def of(text):
        """(id, first byte, end) of all tokens of both; none where bytes differ."""
        if not text:
            return [], []
        whole, out = (" " + text).encode(), []
        for ids, raw in ((a.encode(" " + text, add_special_tokens=False).ids,
                          lambda i: bytes(letter[c] for c in a.id_to_token(i))),
                         (b.encode(text),
                          lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                          else b.id_to_piece(i).replace("▁", " ").encode())):
            at, some, joined = 0, [], b""
            for i in ids:
                x = raw(i)
                some.append((i, at, at + len(x)))
                at, joined = at + len(x), joined + x
            if joined != whole:
                return [], []
            out.append(some)
        return out

    return of


def brute(rows):
    """rows: (doc_id, text) -> result rows and the pair counts."""
    of, docs, count = tokens(), [], Counter()
    for doc, text in rows:
        a, b = of(text)
        links = []
        for i, s, e in a:
            links += [(i, j) for j, t, f in b if s < f and t < e]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end)
                                   for side in (a, b)))
            start = end
        docs.append((doc, a, b, groups, links))
        count.update(links)
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(((doc, len(a), len(b), len(groups), len(links),
                    sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
                   for doc, a, b, groups, links in docs), key=repr), count


ROWS = [(1, None), (2, ""), (3, " "), (4, "one"), (4, "one"), (5, "two words"), (6, "  two\n\n\n  words \t"),
        (None, "no id"), (7, "漢字 😀 é über naïve\x00nul"), (8, "▁marked▁text"), (9, "<s> <|endoftext|> </s> <unk>"),
        (10, "aaaaaaaaaaaaa bbbbbb 1234567890 3.14159"), (11, "é combining ﬁ 　 wide"),
        (12, "antidisestablishmentarianism " * 40), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, 5, "x", "y") for d, t in ROWS],
                                 "doc_id long, text string, n_a int, row string, key string")


def result(texts):
    assert texts.columns == COLUMNS
    return sorted((tuple(r) for r in texts.collect()), key=repr)


def test_edges(spark, docs):
    want, count = brute(ROWS)
    texts, pairs = align_texts(docs)
    assert result(texts) == want
    assert {(r.a_id, r.b_id): r.n for r in pairs.collect()} == dict(count)


def test_pairs_beyond_the_head_and_what_a_task_holds(spark, docs, monkeypatch):
    monkeypatch.setattr(alignment, "HEAD_PAIRS", 3)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 2)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 20)
    assert result(align_texts(docs)[0]) == brute(ROWS)[0]


def test_kept_columns(spark, docs):
    got = align_texts(docs, keep=("key", "doc_id", "row", "n_a"))[0]
    assert got.columns == ["key", "doc_id", "row", *COLUMNS[1:]]
    assert {(r.key, r.row) for r in got.collect()} == {("y", "x")}


def test_empty_table(spark, docs):
    texts, pairs = align_texts(docs.limit(0))
    assert result(texts) == [] and pairs.count() == 0


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 4000]
    got = {r[0]: r for r in result(op13_tokenizer_alignment(spark, SF001))}
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    # what a text has by itself; corpus-wide counts below
    for want in brute(rows)[0]:
        assert got[want[0]][1:5] == want[1:5] and got[want[0]][7] == want[7]


def test_counts_over_a_whole_table(spark):
    some = spark.read.parquet(f"{SF001}/documents.parquet").where("length(text) < 3000").select("doc_id", "text")
    want, count = brute([tuple(r) for r in some.collect()])
    texts, pairs = align_texts(some)
    assert result(texts) == want
    assert {(r.a_id, r.b_id): r.n for r in pairs.collect()} == dict(count)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_a_are_those_of_its_tokenizer(vocabularies, text):
    v, a = vocabularies
    assert v._a_ids(" " + text).tolist() == a.encode(" " + text, add_special_tokens=False).ids


def test_every_character_and_very_long_runs(vocabularies):
    v, a = vocabularies
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}\n" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    want = a.encode_batch_fast(texts, add_special_tokens=False)
    assert all(v._a_ids(t).tolist() == x.ids for t, x in zip(texts, want))
    for t in (" " * 1_200_000, "!" * 50_000, "\n \n" * 20_000):
        assert v._a_ids(t).tolist() == a.encode(t, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def vocabularies():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    with open(A_PATH, "rb") as x, open(B_PATH, "rb") as y:
        return alignment.Vocabularies(x.read(), y.read()), a

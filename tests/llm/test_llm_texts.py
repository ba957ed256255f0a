"""License scan, quality rules, line dedup, chat: brute force and oracles."""

import pytest

import brute
from compare import compare, duck
from pulseline.llm.chat import END, rotate
from pulseline.llm.common import table
from pulseline.llm.licenses import NOTICES, op2_license_scan, scan_licenses
from pulseline.llm.linedup import dedup_lines
from pulseline.llm.quality import op8_quality_rules
from pulseline.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", SQL)
def test_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), SQL[name]) == []


def test_licenses(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in op2_license_scan(spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.phrases(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_notices_with_changes(spark):
    mit = next(t for t in NOTICES if t.startswith("permission"))
    words = mit.split()
    edited = " ".join(words[:6] + ["really"] + words[6:15] + words[16:])
    texts = [mit, "x y " + mit + " z", edited, " ".join(words[:8]), " ".join(reversed(words)),
             "All rights reserved all rights reserved", "licensed under\nthe APACHE License; version 2.0"]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(7)] == ["mit", "mit", "mit", "", "", "reserved", "apache-2.0"]
    assert got[0].score == got[1].score == 1.0 and 0.75 <= got[2].score < 1
    assert (got[5].n_base, got[5].first_word, got[5].last_word) == (2, 0, 3)


def test_quality_counts_and_labels(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    label = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = op8_quality_rules(spark, SF).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == brute.quality(docs[r.doc_id])
    judged = [(label[r.doc_id], r.kept) for r in got if r.doc_id in label and not r.base_failed]
    good = [k for q, k in judged if q]
    assert sum(good) >= 0.99 * len(good)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_quality_rejects_bad_and_keeps_good(spark, sf):
    """Of the labelled documents that pass the base rules."""
    label = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    judged = [(label[r.doc_id], r.kept) for r in op8_quality_rules(spark, sf).collect()
              if r.doc_id in label and not r.base_failed]
    bad, good = [k for q, k in judged if not q], [k for q, k in judged if q]
    assert bad.count(False) >= 0.9 * len(bad) and good.count(True) >= 0.99 * len(good)


def test_line_dedup_on_hot_lines(spark):
    line, other = "the very same line of words", "a line that only two sites have"
    rows = [(i, f"own words of text number {i} and more of them to be long enough\n{line}\n"
             + (other if i % 4 < 2 else "something else entirely"), f"s{i % 4}") for i in range(40)]
    rows += [(100, None, "s1"), (101, "", None), (102, line, "s3")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"),
                      removed_col="removed")
    want = brute.boilerplate(rows)
    assert {r.doc_id: (r.removed, r.text) for r in got.collect()} == {
        d: (g, t) for d, (g, t) in want.items()}
    assert sum(bool(g) for g, _ in want.values()) == 40


def test_line_dedup_of_pages_that_are_mostly_boilerplate(spark):
    """However much of a page the line is, all but its first occurrence go."""
    line = "a passage of many words " * 12
    rows = [(i, f"own {i}\n{line}", f"site{i}") for i in range(5)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"),
                      removed_col="removed").orderBy("doc_id").collect()
    assert [r.removed for r in got] == [[], [1], [1], [1], [1]]
    assert [r.text for r in got][1:] == [f"own {i}" for i in range(1, 5)]


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "<|im_end|> hello"),
            (1, 3, "ann", None), (1, 3, "ann", None), (2, 0, "system", "alone"), (None, None, None, "x"),
            *((3, i, "ab"[i % 2], f"turn {i}") for i in range(200))]
    got = rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    of = {(r.conv_id, r.speaker, r.block): r for r in got}
    assert set(of) == {(1, "ann", 0), (1, "bob", 0), (None, "", -1),
                       *((3, s, b) for s in "ab" for b in range(4))}
    ann = of[1, "ann", 0]
    assert ann.text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
                        "<|im_start|>user name=bob\n< |im_end|> hello<|im_end|>\n"
                        "<|im_start|>assistant\n<|im_end|>\n")
    assert [ann.text[s:e] for s, e in ann.mask] == ["hi" + END, END]
    whole = "".join(of[3, "a", b].text for b in range(4))
    assert whole.count("assistant\n") == 100 and whole.index("turn 0<") < whole.index("turn 199<")


def test_chat_blocks_are_bounded(spark):
    """Null turns, one turn number for all and null conversations: no row has
    more messages than a block has turns, and none is lost."""
    rows = [(i % 3 or None, t, "ab"[i % 2], f"text {i:04d}") for i in range(900) for t in (None, 7)]
    rows += [(4, i, "ab"[i % 2], f"text {i:04d}") for i in range(64)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rotate(turns.repartition(7)).collect()
    assert max(r.n_messages for r in got) == 64
    for conv in (None, 1, 2, 4):
        for block in (-1, 0):
            mine = sorted((r for r in got if (r.conv_id, r.speaker, r.block) == (conv, "a", block)),
                          key=lambda r: r.part)
            want = sorted({(role, text) for c, t, role, text in rows
                           if c == conv and (t is None) == (block == -1)},
                          key=lambda x: x if conv != 4 else x[1])
            assert [r.part for r in mine] == list(range(-(-len(want) // 64)))
            assert "".join(r.text for r in mine) == "".join(
                f"<|im_start|>{'assistant' if role == 'a' else 'user name=' + role}\n{text}{END}"
                for role, text in want)
            for r in mine:
                assert r.n_own == len(r.mask) == r.text.count("assistant\n")
                assert all(r.text[s:e].startswith("text ") for s, e in r.mask)

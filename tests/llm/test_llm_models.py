"""SimHash, FM-index, suffix tree, language ID, SentencePiece."""

import dataclasses
import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import brute
from pulseline.llm import pst, simhash
from pulseline.llm.common import table
from pulseline.llm.fmindex import FmIndex, decontaminate, op10_benchmark_decontamination, scan_benchmark, suffix_array
from pulseline.llm.langid import op6_language_id
from pulseline.llm.pieces import MODEL, Codec, build_tokenizer
from suffix_tree import SuffixTree, candidates

SF = "/root/testdata/sf0.01"


def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}


def test_simhash_components(spark):
    prints = {d: brute.simhash(t) for d, t in texts(spark).items()}
    want = brute.components(sorted(prints.items()))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op7_simhash_near_dedup(spark, SF).collect()}
    assert got == {d: (f"{prints[d]:016x}", want[d]) for d in prints}


@pytest.mark.parametrize("max_shard", [simhash.MAX_SHARD, 4])
def test_no_link_is_lost(spark, max_shard):
    """Chains and clusters of fingerprints, with shards small enough to be split."""
    rnd = random.Random(5)
    values = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(12):
            values.add(x)
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                x ^= 1 << b
    values |= {1 << b for b in range(64)} | {0, 7, 1 << 63}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), max_shard=max_shard)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    mask = (1 << 64) - 1
    want = brute.components([(v, v & mask) for v in sorted(signed)])
    assert {v: got.get(v, v) for v in signed} == want


def test_bk_tree_finds_all():
    rnd = random.Random(2)
    tree, seen = simhash.BkTree(), []
    for _ in range(600):
        x = rnd.getrandbits(10)
        assert sorted(tree.near_then_add(x, 2)) == [i for i, y in enumerate(seen) if (x ^ y).bit_count() <= 2]
        seen.append(x)


def test_fm_index():
    rnd = random.Random(3)
    for _ in range(150):
        text = np.array([rnd.randint(0, 3) for _ in range(rnd.randint(1, 60))] + [0])

        def key(i):
            out = []
            for j in range(i, len(text)):
                out.append((1, int(text[j])) if text[j] else (0, j))
                if not text[j]:
                    return out

        assert suffix_array(text).tolist() == sorted(range(len(text)), key=key)
        index = FmIndex(text, 3)
        wanted = [[rnd.randint(1, 3) for _ in range(rnd.randint(1, 4))] for _ in range(20)]
        rows = np.zeros((20, 4), np.int64)
        for r, p in zip(rows, wanted):
            r[:len(p)] = p
        found = {int(k): sorted(index.locate(np.arange(a, b)).tolist())
                 for k, a, b in zip(*index.search(rows, np.array([len(p) for p in wanted])))}
        for k, p in enumerate(wanted):
            at = [i for i in range(len(text)) if text[i:i + len(p)].tolist() == p]
            assert found.get(k, []) == at


def test_contamination(spark):
    known = brute.windows([(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
    want = {d: brute.contamination(t, known) for d, t in texts(spark).items()}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in op10_benchmark_decontamination(spark, SF).collect()}
    assert got == want and any(x[4] for x in want.values())


def test_decontamination_in_blocks(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    known = brute.windows([(r.item_id, r.text) for r in bench.collect()])
    before = texts(spark)
    after = {r.doc_id: r.text for r in decontaminate(docs, bench, block_bytes=9000).collect()}
    for d, t in before.items():
        if brute.contamination(t, known)[4]:
            assert d not in after or not brute.contamination(after[d], known)[4]
        else:
            assert after[d] == t
    item = bench.first().text
    loud = "".join(c.upper() if c < "\x80" else c for c in item).rstrip(".")
    mixed = spark.createDataFrame([(1, f"AN Éarly Start, {loud} and THE end"), (2, item)],
                                  "doc_id long, text string")
    assert [r.text for r in decontaminate(mixed, bench).collect()] == ["AN Éarly Start,  and THE end"]
    one = {r.doc_id: (r._starts, r._ends, r._items) for r in scan_benchmark(docs, bench).collect()}
    many = {r.doc_id: (r._starts, r._ends, r._items) for r in scan_benchmark(docs, bench, block_bytes=9000).collect()}
    assert one == many


def test_base_scores(spark):
    docs = texts(spark)
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d in docs]
    want, n = brute.base_scores(list(docs.values()), held)
    got = {r.doc_id: r for r in pst.op3_lm_scoring(spark, SF).collect()}
    for d, h, (tokens, known, score) in zip(docs, held, want):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, tokens, known, n)
        assert r.base_score == pytest.approx(score)
    # the tree knows the texts' structure: far fewer bits a byte than uniform bytes
    sizes = {d: len(pst.stream(t.encode())[0]) + 1 for d, t in docs.items()}
    held_ids = [d for d, h in zip(docs, held) if h]
    bits = -sum(got[d].score for d in held_ids) / sum(sizes[d] for d in held_ids) * np.log2(10)
    assert bits < 3.5


def test_suffix_tree(spark):
    lines = ["abracadabra " * 20, "abacab " * 30, "the quick brown fox " * 10, "über " * 10, ""]
    rows = candidates(spark.createDataFrame([(x,) for x in lines], "text string"), min_share=1e-3)
    tree = SuffixTree(rows)
    assert tree.contexts and tree.n_states >= len(tree.contexts)
    chance = 10 ** tree.log10.reshape(tree.n_states, tree.width).astype(float)
    unseen = 256 - (tree.width - 1)
    assert np.allclose(chance[:, :-1].sum(axis=1) + unseen * chance[:, -1], 1, atol=1e-5)
    # the automaton is always in the longest retained context, also across lanes
    retained = set(tree.contexts) | {b""}
    states = {}
    for line in [pst.stream(x.encode())[0] for x in [*lines, "cadabra zzz über fox " * 200]]:
        padded = bytes([pst.END]) * pst.DEPTH + line + bytes([pst.END])
        total = 0.0
        for i in range(pst.DEPTH, len(padded)):
            context = next(padded[k:i] for k in range(i - pst.DEPTH, i + 1) if padded[k:i] in retained)
            states.setdefault(context, tree_row(tree, context, chance))
            total += np.log10(states[context][tree.column[padded[i]]])
        assert tree.score([line])[0] == pytest.approx(total, rel=1e-4)


def tree_row(tree, context, chance):
    """Distribution after reading a context from the root."""
    s = 0
    for b in context:
        s = tree.step[s + tree.column[b]]
    return chance[s // tree.width]


def test_language_accuracy(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    got = op6_language_id(spark, SF).collect()
    assert {r.held_out for r in got} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.98 * len(held)


def test_piece_parity():
    with open(MODEL, "rb") as f:
        codec = Codec(f.read())
    rnd = random.Random(0)
    bits = [" ", "  ", "   ", "\n", "\n\n", "\t", "a", "the", "<s>", "</s>", "<0x0A>", "▁", "▁▁", "é", "漢", "😀",
            "\x00", "ﬁ", "    " * 7, "Hello", "aaaa", "====", "----", "....", "1234567", "​"]
    texts = ["", " "] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    ids, same = codec.encode(texts)
    # the ids are those of the rebuilt pipeline; the other library's come from it alone
    reference = sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(texts)
    rebuilt = [x.ids for x in codec.mine.encode_batch(texts, add_special_tokens=False)]
    assert all(same) and ids == rebuilt == reference
    back = codec.decode(ids)
    assert back == codec.exact.decode(ids) == codec.mine.decode_batch(ids, skip_special_tokens=False)
    assert back == [t.replace("▁", " ") for t in texts]


def test_rows_where_the_libraries_differ_say_so():
    """With merges in another order, parity is false and the exact ids stay."""
    with open(MODEL, "rb") as f:
        codec = Codec(f.read())
    m = codec.model
    wrong = [(p, -s, k) for p, s, k in m.pieces]
    codec.mine = build_tokenizer(dataclasses.replace(m, pieces=wrong))
    some = ["", "the quick brown fox", "hello world"]
    ids, same = codec.encode(some)
    assert ids == sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(some)
    assert same == [True, False, False]


def test_sql_digest_matches_ids(spark):
    from pulseline.llm.pieces import op5_sentencepiece
    docs = texts(spark)
    ids = sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(list(docs.values()))
    want = {d: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for d, x in zip(docs, ids)}
    got = op5_sentencepiece(spark, SF).collect()
    assert {r.doc_id: r.ids_sha256 for r in got} == want and all(r.parity and r.round_trip for r in got)


def test_tree_grows_with_the_corpus(spark):
    """A context of a fixed number of occurrences is in the model however
    large the rest is, and grams outside the broadcast head are scored alike."""
    rnd = random.Random(4)
    rare = [(i, "qzxjk vwqzx") for i in range(40)]
    bulk = [(100 + i, " ".join(rnd.choices(["alpha", "beta", "gamma", "delta"], k=10_000)))
            for i in range(150)]
    docs = spark.createDataFrame(rare + bulk + [(999, "qzxjk beta über vwqzx")], "doc_id long, text string")
    held = F.col("doc_id") == 999
    tree = SuffixTree(candidates(docs.where(~held)))
    assert any(set(b"qzxjk") & set(c) for c in tree.contexts)
    lines = {r.doc_id: pst.stream(r.text.encode())[0] for r in docs.collect()}
    want = dict(zip(lines, tree.score(list(lines.values()))))
    for bits in (0, 12, pst.GRAM_HEAD_BITS):
        got = {r.doc_id: r.score for r in pst.score_texts(docs, held, gram_head_bits=bits).collect()}
        assert got == pytest.approx(want, rel=1e-4)
    assert want[0] > -6  # two words of 12 symbols in all, next to certain

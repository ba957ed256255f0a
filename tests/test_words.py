from pulseline.operators import words


def _texts(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")


def test_split_rule(spark):
    cases = {"hello a  b": ["hello", "a", "", "b"], "": [""], "a b  ": ["a", "b"], " ": [],
             " a": ["", "a"]}
    toks = words.tokenize(_texts(spark, list(cases))).collect()
    for i, (text, want) in enumerate(cases.items()):
        got = [r.word for r in sorted((r for r in toks if r.doc_id == i), key=lambda r: r.pos)]
        assert got == want, text


def test_seeded_running_count(spark):
    chunked = words.with_text_chunk(_texts(spark, ["hello a  b", "", "a b hello"]), texts_per_chunk=1)
    t = words.tokenize(chunked, carry=(words.CHUNK,))
    got = {}
    for r in words.running_word_count(t).orderBy("doc_id", "pos").collect():
        got.setdefault(r.word, []).append(r.n)
    assert got == {"hello": [2, 3], "a": [1, 2], "b": [1, 2], "": [1, 2]}
    totals = {r.word: r.n for r in words.word_totals(t).collect()}
    assert totals == {"hello": 3, "a": 2, "b": 2, "": 2}


def test_an_outlier_id_does_not_undo_the_chunks(spark):
    """A frequent word stays spread over many tasks beside an id far away."""
    texts = spark.createDataFrame([(i if i else 2 ** 60, "the end") for i in range(700)],
                                  "doc_id BIGINT, text STRING")
    chunked = words.with_text_chunk(texts)
    per = [r["count"] for r in chunked.groupBy(words.CHUNK).count().collect()]
    assert max(per) <= 2 * words.CHUNK_TEXTS and len(per) >= 10
    t = words.tokenize(chunked, carry=(words.CHUNK,))
    got = sorted((r.doc_id, r.n) for r in words.running_word_count(t).collect() if r.word == "the")
    assert got == [(i, i) for i in range(1, 700)] + [(2 ** 60, 700)]


def test_a_chunk_in_lists_is_counted_without_sorting_its_words(spark):
    """The same counts from lists and from rows, with ids that repeat or are
    missing, and with chunks too large to hold; words aren't sorted with ids."""
    texts = ["hello a  b", "", None, "  ", "a b hello a", "b a world", "é é a", "a a b", " x", "a", "b b world a"]
    ids = [5, 1, 2, 3, None, 5, 9, None, 5, 2 ** 40, -7]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id BIGINT, text STRING")
    frame_seed = words.seed_frame(spark, [("b", 4)])
    for seed, per, most in ((words.DEFAULT_WORD_SEED, 1, words.MOST_BYTES), (words.DEFAULT_WORD_SEED, 3, 12),
                            ([("a", 10), ("nowhere", 3)], 100, words.MOST_BYTES), (frame_seed, 3, 0)):
        rows = words.running_word_count(words.tokenize(df), seed)
        chunked = words.with_text_chunk(df, texts_per_chunk=per)
        lists = words.tokenize(chunked, carry=(words.CHUNK,), lists=True)
        got = words.running_word_count(lists, seed, most_bytes=most)
        assert got.columns == rows.columns and got.dtypes == rows.dtypes
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr), (per, most)
    plan = words.running_word_count(lists)._jdf.queryExecution().executedPlan().toString()
    sorts = [x for x in plan.splitlines() if " Sort [" in x]
    assert "FlatMapCoGroupsInArrow" in plan and not [x for x in sorts if "pos#" in x]


def test_chunks_follow_the_size_of_texts(spark):
    df = _texts(spark, ["é" * 50, "x" * 300, None])
    assert words.texts_per_chunk(df, chunk_bytes=1_000) == 5
    assert words.texts_per_chunk(df, chunk_bytes=10) == 1
    assert words.texts_per_chunk(df.limit(0), chunk_bytes=10) == 10

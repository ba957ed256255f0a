import pytest

from conftest import SF01

from pulseline.operators import reconcile as rc


def _parts(spark, contents, target="a"):
    return spark.createDataFrame(
        [(target, str(i + 1), i + 1, c) for i, c in enumerate(contents)],
        "target STRING, source STRING, source_rank BIGINT, content STRING")


def _text(df):
    rows = sorted(df.collect(), key=lambda r: (r.source_rank, r.line_no))
    return [r.content for r in rows]


PARTS = ["1\n", "2\n", "1\n3\n"]


def test_concat(spark):
    assert "".join(_text(rc.resolve_concat(_parts(spark, ["1", "2", "1\n3"])))) == "1\n2\n1\n3\n"


def test_first_last(spark):
    assert _text(rc.resolve_first(_parts(spark, PARTS))) == ["1\n"]
    assert _text(rc.resolve_last(_parts(spark, PARTS))) == ["1\n3\n"]


def test_distinct_lines(spark):
    assert _text(rc.resolve_distinct_lines(_parts(spark, PARTS))) == ["1", "2", "3"]


def test_deduplicate(spark):
    ok, conf = rc.resolve_deduplicate(_parts(spark, ["1\n", "1\n", "1\n"]))
    assert _text(ok) == ["1\n"] and conf.count() == 0
    ok, conf = rc.resolve_deduplicate(_parts(spark, PARTS))
    assert ok.count() == 0 and conf.first().n_sources == 3


def test_single_or_error_and_raise(spark):
    res = rc.reconcile(_parts(spark, ["x", "y"]), rules=[(".*", rc.SINGLE_OR_ERROR)])
    with pytest.raises(rc.ReconcileConflict):
        res.raise_on_conflict()


def test_discard_and_rules(spark):
    parts = _parts(spark, PARTS, target="f").unionByName(_parts(spark, PARTS, target="d"))
    res = rc.reconcile(parts, rules=[("^f$", rc.DISCARD), ("^d$", rc.FILTER_DISTINCT_LINES)])
    assert {r.target for r in res.resolved.collect()} == {"d"}
    counts = {r.strategy: r.n_targets for r in res.counts.collect()}
    assert counts == {"discard": 1, "filterDistinctLines": 1}


def test_rename(spark):
    df = spark.createDataFrame([("README", "1", 1, "x"), ("META-INF/NOTICE.txt", "2.jar", 2, "y")],
                               "target STRING, source STRING, source_rank BIGINT, content STRING")
    got = {r.target for r in rc.resolve_rename(df).collect()}
    assert got == {"README_1", "META-INF/NOTICE_2.txt"}


def test_null_contents(spark):
    parts = spark.createDataFrame(
        [("all", "1", 1, None), ("all", "2", 2, None), ("some", "1", 1, None), ("some", "2", 2, "x")],
        "target STRING, source STRING, source_rank BIGINT, content STRING")
    ok, conf = rc.resolve_deduplicate(parts)
    assert [r.target for r in ok.collect()] == ["all"] and [r.target for r in conf.collect()] == ["some"]
    res = rc.reconcile(parts)
    assert [r.target for r in res.resolved.collect()] == ["all"]
    assert [r.target for r in res.conflicts.collect()] == ["some"]


def test_renamed_parts_meet_again(spark):
    parts = spark.createDataFrame(
        [("NOTICE.txt", "a", 1, "one"), ("NOTICE.txt", "b", 2, "two"), ("NOTICE_a.txt", "c", 3, "three"),
         ("README", "a", 4, "x"), ("README", "a", 5, "y")],
        "target STRING, source STRING, source_rank BIGINT, content STRING")
    rules = [("^NOTICE[.]txt$", rc.RENAME), ("^README$", rc.RENAME), ("^README_a$", rc.CONCAT)]
    res = rc.reconcile(parts, rules)
    assert {(r.target, r.strategy, r.content) for r in res.resolved.collect()} == {
        ("NOTICE_b.txt", "deduplicate", "two"), ("README_a", "concat", "x\n"), ("README_a", "concat", "y\n")}
    assert [(r.target, r.n_sources) for r in res.conflicts.collect()] == [("NOTICE_a.txt", 2)]
    assert {r.strategy: r.n_targets for r in res.counts.collect()} == {
        "rename": 2, "concat": 1, "deduplicate": 1}
    with pytest.raises(rc.ReconcileConflict, match="NOTICE_a.txt"):
        res.raise_on_conflict()


def test_rules_read_the_parts_at_most_twice(spark):
    from pulseline.plans import catalog
    plan = catalog.reconcile_by_rule(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2


def test_table_scale_counts(spark):
    from pulseline.plans.catalog import order_parts
    parts = order_parts(spark, SF01)
    agg = rc._by_target(parts)
    n = agg.count()
    single = agg.filter("n_sources = 1").count()
    same = agg.filter("n_sources > 1 AND same_content").count()
    assert (n, single, same, n - single - same) == (6470, 1965, 905, 3600)


def _pieces(spark, parts, rules, piece_bytes):
    resolved = rc.reconcile(parts, rules=rules).resolved
    out = {}
    for r in rc.merged_pieces(resolved, piece_bytes).orderBy("target", "piece").collect():
        assert r.offset == piece_bytes * r.piece == len(out.get(r.target, b""))
        assert len(r.content) <= piece_bytes
        out[r.target] = out.get(r.target, b"") + bytes(r.content)
    return out


def test_merged_targets_equal_the_goldens(spark):
    parts = _parts(spark, ["1", "2", "1\n3"])
    for t in ("b", "c", "d", "e", "f"):
        parts = parts.unionByName(_parts(spark, ["1\n", "1\n", "1\n"] if t == "e" else ["1", "2", "1\n3"], t))
    rules = [("^a$", rc.CONCAT), ("^b$", rc.FIRST), ("^c$", rc.LAST), ("^d$", rc.FILTER_DISTINCT_LINES),
             ("^e$", rc.DEDUPLICATE), ("^f$", rc.DISCARD)]
    for piece_bytes in (1, 3, 100):
        got = _pieces(spark, parts, rules, piece_bytes)
        assert {t: c.decode().split() for t, c in got.items()} == {
            "a": ["1", "2", "1", "3"], "b": ["1"], "c": ["1", "3"], "d": ["1", "2", "3"], "e": ["1"]}


def test_merged_pieces_of_long_empty_and_many_parts(spark):
    contents = ["é" * 5000, "", None, "x\n", "漢字" * 777, ""]
    parts = _parts(spark, contents, "long").unionByName(_parts(spark, [""], "none"))
    want = "".join(c if (c or "").endswith("\n") else (c or "") + "\n" for c in contents if c is not None)
    got = _pieces(spark, parts, [("long", rc.CONCAT), ("none", rc.FIRST)], 64)
    assert got["none"] == b"" and got["long"].decode() in (want, want.replace("\nx\n", "\n\nx\n"))


def test_a_hot_target_is_merged_by_many_tasks(spark, monkeypatch):
    from pulseline.operators import running
    monkeypatch.setattr(running.equal_count_chunks, "__defaults__", (200,))
    rows = [("hot", str(i), i, f"part {i} of the hot target") for i in range(4000)]
    rows += [(f"t{i % 50}", str(i), i, f"p{i}") for i in range(1000)]
    parts = spark.createDataFrame(rows, "target STRING, source STRING, source_rank BIGINT, content STRING")
    resolved = rc.reconcile(parts, rules=[(".", rc.CONCAT)]).resolved
    chunks = running.equal_count_chunks(resolved, ["target"], ["source_rank", "line_no"], "c")
    assert chunks.where("target = 'hot'").select("c").distinct().count() >= 15
    got = _pieces(spark, parts, [(".", rc.CONCAT)], 1000)
    assert got["hot"].decode() == "".join(f"{r[3]}\n" for r in rows[:4000])
    assert got["t7"].decode() == "".join(f"p{i}\n" for i in range(7, 1000, 50))


def test_conflict_sources(spark):
    parts = _parts(spark, PARTS).unionByName(_parts(spark, ["1", "1"], "same"))
    res = rc.reconcile(parts)
    got = rc.conflict_sources(parts, res.conflicts).collect()
    assert sorted((r.target, r.source, r.source_rank) for r in got) == [("a", "1", 1), ("a", "2", 2), ("a", "3", 3)]

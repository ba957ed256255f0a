"""The pipeline on sf0.001: every stage against a plain version of what it keeps."""

import brute
import corpus_pipeline
from pulseline.llm.common import table
from pulseline.llm.quality import quality_verdicts
from pulseline.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        verdict = {r.doc_id: r.kept for r in quality_verdicts(docs).collect()} if not seen else {}
        docs = materialize(stage(spark, docs, SF), "stage")
        after = {r.doc_id: r for r in docs.collect()}
        seen[name] = len(after)
        assert set(after) <= set(before) and docs.columns[:len(columns)] == columns
        assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "quality rules":
            assert set(after) == {d for d, k in verdict.items() if k}
            assert not any(brute.quality(r.text)[5] for r in after.values())
        elif name == "line dedup":
            want = brute.boilerplate([(r.doc_id, r.text, r.source) for r in before.values()])
            assert {d: r.text for d, r in after.items()} == {d: t for d, (_, t) in want.items()}
        elif name == "simhash near-dedup":
            part = brute.components(sorted((d, brute.simhash(r.text)) for d, r in before.items()))
            assert set(after) == set(part.values())
        elif name == "benchmark decontamination":
            known = brute.windows(bench)
            assert not any(brute.contamination(r.text, known)[4] for r in after.values())
            clean = {d for d, r in before.items() if not brute.contamination(r.text, known)[4]}
            assert clean <= set(after) and all(after[d] == before[d] for d in clean)
        else:
            assert set(after) == set(before)
            assert all(r.parity and r.round_trip and r.n_tokens == len(r.input_ids) for r in after.values())
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.text, r.input_ids) for r in whole} == {
        d: (r.text, r.input_ids) for d, r in after.items()}

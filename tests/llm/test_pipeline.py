"""The pipeline: stages keep the documents' columns, decisions take effect, the end agrees with the stages run by hand."""

from __future__ import annotations

import corpus_pipeline
from lodestrata.llm import common, line_templates, pii, quality_rules


def test_stages(spark, sample):
    docs = sample
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stage(stage(spark, docs, ""), "test")
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
        docs = out
    finder = pii.automaton()
    assert not [r.doc_id for r in docs.collect() if any(s[0] in pii.BASE for s in pii.spans(r.text or "", finder))]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    by_hand = line_templates.dedup(quality_rules.judge(sample).where("kept").select(*sample.columns))
    first = corpus_pipeline.lines(spark, corpus_pipeline.rules(spark, sample, ""), "")
    assert sorted(map(tuple, by_hand.collect())) == sorted(map(tuple, first.collect()))


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)


def test_edges(spark, edge, nothing):
    for df in (edge, nothing):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            docs = common.stage(stage(spark, docs, ""), "test")
        docs.count()

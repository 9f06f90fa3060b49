"""The pipeline end to end on the smallest tables, and stage by stage on odd ones."""

import hashlib
import os

import pytest

import corpus_pipeline as pipeline
from quarry.llm import bpe, decontaminate, quality_rules

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_run_is_the_stages_in_order(spark):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "byte_bpe"]
    import zstandard
    z = zstandard.ZstdCompressor(level=3)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    tests = decontaminate.TestSet([(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    for name, stage in pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, SF).cache()
        assert now.schema.fieldNames() == docs.schema.fieldNames()
        old, new = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in now.collect()}
        assert new.keys() <= old.keys()
        if name == "quality_rules":
            assert new == {i: t for i, t in old.items() if quality_rules.judge(t, z)[6]}
        if name == "decontaminate":
            hits = decontaminate.match_texts(list(old.values()), tests)[1]
            assert new == {i: t for (i, t), h in zip(old.items(), hits, strict=True) if not h}
    codec = bpe.codec(*bpe.default_vocabulary())
    want = {i: (len(codec.encode(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in new.items()}
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in pipeline.run(spark, SF).collect()} == want


def test_stages_take_odd_and_empty_tables(spark, odd, tmp_path):
    spark.createDataFrame([(1, "some words of a benchmark item that are not in any text")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for docs in (odd, odd.limit(0)):
        now = docs
        for name, stage in pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.schema == docs.schema, name
        assert pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() == now.count()
        for name, stage in pipeline.STAGES[1:-1]:
            assert stage(spark, docs, str(tmp_path)).count() <= docs.count(), name

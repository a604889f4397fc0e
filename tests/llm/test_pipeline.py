import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from commitlake.llm import bpe, minhash, mixing, quality
from commitlake.llm.common import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage makes of its predecessor's output."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stages_in_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "pii", "mixing", "bpe_encode"]
    assert all(step.columns == steps[0].columns for step in steps[:-1])


def test_each_stage_takes_effect_on_its_own_input(spark, steps):
    raw, good, single, private, mixed, encoded = steps
    weights = quality.fit_weights(raw, quality.trusted_ids(spark.read.parquet(f"{SF}/labels.parquet")))
    kept = {r.doc_id for r in quality.quality_verdicts(raw, weights).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and 0 < len(kept) < raw.count()
    stays = {r.doc_id for r in minhash.near_duplicates(good, 80).where("kept").collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(stays)
    assert private.count() == single.count()
    texts = {r.doc_id: r.text for r in single.collect()}
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for r in private.collect():
        assert not email.search(r.text) and r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or "[" in r.text
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_table(private).where("size > 0").collect()}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in taken.items() if n}
    assert encoded.count() == mixed.count()
    decoded = bpe.decode_documents(encoded, corpus_pipeline.BYTE_BPE)
    lost = decoded.select("doc_id", "decoded").distinct().join(mixed.select("doc_id", "text"), "doc_id").where("decoded != text")
    assert lost.count() == 0


def test_run_equals_the_stages(spark, steps):
    run = corpus_pipeline.run(spark, SF)
    digest = F.sort_array(F.collect_list(F.xxhash64("doc_id", "source", "token_ids")))
    assert run.agg(digest.alias("d")).first().d == steps[-1].agg(digest.alias("d")).first().d

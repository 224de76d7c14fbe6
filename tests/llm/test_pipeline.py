from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from oreworks.llm import decontaminate, packing, quality_gam, set_join, toxicity

from .conftest import documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    """The stages are held against the operators' own decisions, which need no good model."""
    monkeypatch.setattr(toxicity, "READINGS", 1000)


def test_stages_by_their_operators(spark, tmp_path):
    """Each stage on what its predecessor kept, against the operator's own decisions."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = documents(spark, SF)
    columns = docs.columns
    rejects = {
        "quality": lambda d: [r.doc_id for r in quality_gam.quality_scores(d, labels).where("predicted = 0").collect()],
        "toxicity": lambda d: [r.doc_id for r in toxicity.toxicity_scores(d, labels).where("predicted = 1").collect()],
        "near_dedup": lambda d: [r.doc_id for r in set_join.similar_groups(d).where("doc_id <> component_id").collect()],
        "decontaminate": lambda d: [r.doc_id for r in decontaminate.contaminated(d, bench).collect()],
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == [*rejects, "pack"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        gone = set(rejects[name](docs))
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        assert {r.doc_id for r in docs.collect()} == before - gone, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    want = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert {(r.doc_id, r.piece) for r in last.collect()} == {(r.doc_id, r.piece) for r in want.collect()}
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == last.columns
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in last.collect())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_awkward_rows(spark, awkward, no_docs, stage):
    out = stage(spark, awkward, SF)
    assert out.count() > 0
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == awkward.columns
    assert stage(spark, no_docs, SF).count() == 0

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from pairloom.llm import jaccard_join, pii
from pairloom.llm.queries import TOKENIZER


def stages(spark, docs, sf_dir, folder):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_stages(spark, documents, sf_dir, tmp_path):
    content, single, clean, mixed, encoded = stages(spark, documents, sf_dir, str(tmp_path))
    for docs in (content, single, clean, mixed):
        assert docs.schema == documents.schema
    rows = {r.doc_id: r for r in documents.collect()}
    assert all(rows[r.doc_id] == r for r in content.collect())
    labels = {r.doc_id: r.quality for r in
              spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in content.collect()}
    long_enough = [i for i, q in labels.items() if q == 1 and len(rows[i].text.split()) >= 20]
    assert np.mean([i in kept for i in long_enough]) > 0.95
    # One of each group, and no two left that are alike.
    found = jaccard_join.components(content, n=5, percent=80).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in found}
    again = jaccard_join.components(single, n=5, percent=80)
    assert again.select("component_id").distinct().count() == single.count()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()}
    assert pii.find(clean).where("base_spans <> ''").isEmpty()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= set(texts.items())
    library = Tokenizer.from_file(TOKENIZER)
    for row in encoded.collect():
        assert row.ids == library.encode(texts[row.doc_id], add_special_tokens=False).ids


def test_awkward_rows(spark, awkward, sf_dir, tmp_path):
    documents = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    last = stages(spark, documents, sf_dir, str(tmp_path / "rows"))[-1]
    assert last.columns == ["doc_id", "n_tokens", "ids"]
    none = stages(spark, documents.where("false"), sf_dir, str(tmp_path / "none"))
    assert [d.count() for d in none] == [0] * 5


def test_run_is_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0

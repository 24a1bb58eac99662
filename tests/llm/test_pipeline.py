"""The pipeline, stage by stage, against brute force."""

import hashlib

import numpy as np
import pyarrow.parquet as pq
from brute import components, contamination, exact

import corpus_pipeline
from tablelens.llm import bpe, quality
from tablelens.llm.queries import tokenizer
from tablelens.plans.runtime import written

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, sorted((r.doc_id, r.text) for r in docs.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_duplicates", "decontamination", "bpe"]
    out = docs
    results = []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, out, FOLDER), name)
        results.append(out)
        if name != "bpe":
            assert out.columns == columns and out.schema == docs.schema
    kept = [sorted((r.doc_id, r.text) for r in f.collect()) for f in results[:-1]]

    network = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = network.score(np.stack([quality.features(t or "") for _, t in rows]).astype(float))
    assert kept[0] == [r for r, s in zip(rows, scores, strict=True) if s >= 0.5 and (r[1] or "").split()]
    assert kept[1] == [r for r in kept[0] if exact(kept[0])[r[0]][2]]
    found = components(kept[1], 5, 80)
    assert kept[2] == [r for r in kept[1] if found[r[0]][1] == r[0]]
    bench = pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()
    hits = contamination(kept[2], [(b["item_id"], b["text"]) for b in bench], 10)
    assert kept[3] == [r for r in kept[2] if not hits[r[0]][1]]
    assert len(rows) > len(kept[0]) > len(kept[1]) > len(kept[3]) > 0

    path = tokenizer("word_bpe_49k.json")
    expected = set()
    for i, t in kept[3]:
        ids = bpe.load(path).encode(t, add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.add((i, len(ids), digest, hashlib.sha256(bpe.load(path).decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in results[-1].collect()} == expected


def test_stages_on_odd_tables(spark):
    """Empty tables, nulls, repeated rows and extra columns pass through every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (None, "one two three", "en", None, 13)], docs.schema)
    some = docs.limit(20).unionByName(odd).unionByName(docs.limit(5))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
        out = stage(spark, some.selectExpr("*", "text AS digest", "1 AS kept"), FOLDER)
        assert out.count() <= 28
        if name != "bpe":
            assert out.columns == [*docs.columns, "digest", "kept"], name

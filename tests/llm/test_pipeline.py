"""The pipeline's stages on a small corpus: columns, decisions, and the awkward cases."""

from __future__ import annotations

import corpus_pipeline
from tablewright.llm import quality

from .cases import frame
from .test_operators import brute_components, brute_lines, labelled


def stage_inputs(spark, folder):
    docs, labels = labelled(n=200)
    docs += [(3000 + i, docs[10 + i][1], "en", "s", 0) for i in range(5)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    rows = frame(spark, docs, extra=True)
    rows.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return docs


def test_stages(spark, tmp_path):
    rows = stage_inputs(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, str(tmp_path))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        seen.append((before, docs))
    scores = {r.doc_id: r.predicted for r in quality.classify(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    assert {r.doc_id for r in seen[0][1].collect()} == {r[0] for r in rows if scores[r[0]]}
    kept = sorted(((d, n, s) for d, _, n, s in brute_lines(seen[1][0], 90)), key=repr)
    from tests.llm.test_operators import sha

    assert sorted((r.doc_id, sha((r.text or "").encode())) for r in seen[1][1].collect() if r.doc_id is not None) == sorted((d, s) for d, _, s in kept if d is not None)
    numbered = [x for x in seen[2][0] if x[0] is not None]
    least = {d for d, _, c in brute_components(numbered, 5, 80) if d == c}
    assert {r.doc_id for r in seen[2][1].collect() if r.doc_id is not None} == least
    assert {(r.doc_id, r.text) for r in seen[3][1].select("doc_id", "text").collect()} <= seen[3][0]
    assert all(r.round_trip for r in seen[4][1].collect())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, docs.collect()))


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

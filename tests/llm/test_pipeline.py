from collections import Counter

import corpus_pipeline
from periodica.llm.quality_lines import quality
from .brute import base, jaccard_groups, words

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results, columns = [docs], docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, results[-1], SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        results.append(spark.read.parquet(f"{tmp_path}/{i}"))
    texts = [{r.doc_id: r.text for r in x.collect()} for x in results[:4]]
    assert set(texts[1]) == {r.doc_id for r in quality(docs).collect() if r.kept}
    assert not any(base(texts[0][d])[-1] for d in texts[1])
    assert 0 < len(texts[2]) < len(texts[1])
    groups = jaccard_groups(list(texts[2].items()), 5, 80)
    assert set(texts[3]) == {d for d, (_, g) in groups.items() if d == g}
    mixed, sizes = Counter(), {d: len(words(t)) for d, t in texts[3].items()}
    for r in results[4].collect():
        mixed[r.doc_id] += len(words(r.text))
    assert all(n <= 2 * sizes[d] for d, n in mixed.items())
    assert abs(sum(mixed.values()) - 1.5 * sum(sizes.values())) < 0.02 * sum(sizes.values())
    assert results[5].select("sequence_id", "offset").distinct().count() == results[5].count()
    assert {r.doc_id for r in results[5].collect()} == set(mixed)


def test_registered():
    import __spark_entry__ as entry
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None
    assert len(corpus_pipeline.STAGES) == 5


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and "sequence_id" in rows.columns

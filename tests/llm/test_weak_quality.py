import numpy as np
from pyspark.sql import functions as F

from periodica.llm.weak_quality import (
    WeakRules, label_model, op10_weak_quality, pattern, training_texts, votes, weak_quality)

SF = "/root/testdata/sf0.01"


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    right = [0.95, 0.9, 0.85, 0.8]
    v = np.stack([np.where(rng.random(len(good)) < 0.1, 0, np.where((rng.random(len(good)) < r) == good, 1, -1)) for r in right], 1)
    counts = np.bincount([pattern(list(x)) for x in v], minlength=3 ** 4)
    share, p, post = label_model(counts, 4, 200)
    assert abs(share - 0.8) < 0.03
    for i, r in enumerate(right):
        assert abs(p[1, i, 2] - 0.9 * r) < 0.03 and abs(p[0, i, 0] - 0.9 * r) < 0.06
    guess = post[[pattern(list(x)) for x in v]] >= 0.5
    assert (guess == good).mean() > 0.93


def test_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in op10_weak_quality(spark, SF).collect()]
    both = [(r.predicted, labels[r.doc_id]) for r in got if r.doc_id in labels]
    assert sum(p == q for p, q in both) / len(both) > 0.95
    assert sum(p >= q for p, q in both if q) / sum(q for _, q in both) > 0.95


def test_edges(spark, edge, empty, clash):
    got = weak_quality(edge).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got)
    assert {tuple(r.votes) for r in got if r.doc_id in (3, 4, 5)} == {(0, 0, 0, -1, 0, 0, 0, 0)} == {tuple(votes(None))}
    assert weak_quality(empty).count() == 0
    assert sorted(map(tuple, weak_quality(clash).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_copies_do_not_shrink_the_sample(spark):
    text = F.concat_ws(" ", F.lit("The cat sat on the mat near the door of house"), F.col("n").cast("string"))
    many = spark.range(30_000).select(F.col("id").alias("n"), F.col("id").alias("doc_id"))
    plain = many.select("doc_id", text.alias("text"))
    copied = many.withColumn("n", F.when(F.col("n") < 10_000, -1).otherwise(F.col("n"))).select("doc_id", text.alias("text"))
    for docs, kinds, sample in ((plain, 30_000, 2000), (copied, 20_001, 2000)):
        assert docs.select("text").distinct().count() == kinds
        assert abs(training_texts(docs, WeakRules(sample=sample)).count() - sample) < 150
    repeated = many.withColumn("n", F.col("n") % 7).select("doc_id", text.alias("text"))
    assert training_texts(repeated, WeakRules(sample=10)).count() == 7            # fewer than the sample: all
    got = weak_quality(repeated, WeakRules(sample=10)).select("score").distinct().collect()
    assert all(r.score != 0.5 for r in got)

import zlib

import numpy as np
import pytest

from periodica.llm.toxicity import CrfRules, clean_documents, marginals, op9_toxic_crf, toxic_documents

SF = "/root/testdata/sf0.01"


def _plain(odds, opens, start, trans):
    """Forward-backward, document by document."""
    out, n = [], len(odds)
    cuts = [*np.flatnonzero(opens).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        e = np.column_stack([np.ones(b - a), odds[a:b]])
        f, g = np.zeros((b - a, 2)), np.ones((b - a, 2))
        f[0] = start * e[0]
        f[0] /= f[0].sum()
        for t in range(1, b - a):
            f[t] = (f[t - 1] @ trans) * e[t]
            f[t] /= f[t].sum()
        for t in range(b - a - 2, -1, -1):
            g[t] = trans @ (e[t + 1] * g[t + 1])
            g[t] /= g[t].sum()
        p = f * g
        out += (p[:, 1] / p.sum(1)).tolist()
    return np.array(out)


def _log_z(odds, opens, start, trans):
    """Log of the sum over all labellings, document by document."""
    total, cuts = 0.0, [*np.flatnonzero(opens).tolist(), len(odds)]
    for a, b in zip(cuts, cuts[1:]):
        f = start * [1, odds[a]]
        for t in range(a + 1, b):
            total += np.log(f.sum())
            f = (f / f.sum()) @ trans * [1, odds[t]]
        total += np.log(f.sum())
    return total


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 300])
def test_pairwise_marginals(n):
    """Expected transitions are the derivatives of the log partition function."""
    rng = np.random.default_rng(n)
    odds, opens = np.exp(rng.normal(size=n) * 2), rng.random(n) < 0.05
    opens[:1] = True
    start, t = np.exp(rng.normal(size=2)), rng.normal(size=(2, 2)) * 2
    p, both = marginals(odds, opens, start, np.exp(t), True)
    assert np.allclose(p, _plain(odds, opens, start, np.exp(t)), atol=1e-9) and both.shape == (4, n)
    inner = ~opens
    assert np.allclose((both[1] + both[3])[inner], p[inner])
    for i in range(4):
        step = np.zeros(4)
        step[i] = 1e-5
        up, down = (_log_z(odds, opens, start, np.exp(t + k * step.reshape(2, 2))) for k in (1, -1))
        assert abs((up - down) / 2e-5 - both[i, inner].sum()) < 1e-4


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_marginals(n):
    rng = np.random.default_rng(n)
    odds, opens = np.exp(rng.normal(size=n) * 4), rng.random(n) < 0.05
    opens[:1] = True
    start, trans = np.exp(rng.normal(size=2)), np.exp(rng.normal(size=(2, 2)) * 2)
    assert np.allclose(marginals(odds, opens, start, trans), _plain(odds, opens, start, trans), atol=1e-9)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op9_toxic_crf(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    both = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == t for p, t in both) / len(both) >= 0.93
    assert sum(p > t for p, t in both) <= 0.03 * len(both)


def test_scores_ignore_everything_but_the_text(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a = {r.doc_id: r.score for r in toxic_documents(docs, labels).collect()}
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(string(doc_id)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    b = {r.doc_id: r.score for r in toxic_documents(docs.selectExpr("doc_id", "text", "'x' AS lang", "1 AS source"), flipped).collect()}
    assert a == b


def test_edges(spark, edge, empty, clash):
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, None), (6, 0), (None, 1), (8, 0)], "doc_id long, toxic int")
    got = toxic_documents(edge, labels).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert toxic_documents(empty, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxic_documents(edge, none).collect()} == {0.5}
    assert clean_documents(clash, labels).columns == clash.columns


def test_spans(spark):
    docs = [(i, f"good day to you my dear friend number {i}" + (" you utter Zorkface, really" if i % 3 == 0 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    rows = toxic_documents(spark.createDataFrame(docs, "doc_id long, text string"), labels, CrfRules()).collect()
    texts = dict(docs)
    for r in rows:
        said = [texts[r.doc_id][s.start:s.end] for s in r.spans]
        assert any("Zorkface" in x for x in said) == (r.doc_id % 3 == 0) and r.predicted == (r.doc_id % 3 == 0)


@pytest.mark.parametrize("learn", ["toxicity", "packing"])
def test_what_a_worker_keeps_for_later_stages_is_small(learn):
    """Python workers live on: the word caches of two stages stay in one worker while others run."""
    import tracemalloc

    import public_tokenizers

    from periodica.llm.packing import TOKENIZER, WordIds
    from periodica.llm.toxicity import Model, Scorer
    rules = CrfRules()
    ones = Model(np.zeros((1 << rules.bits) + 1), np.ones(2), np.ones((2, 2)), np.ones(4))
    know = WordIds(public_tokenizers.path(TOKENIZER)).ids if learn == "packing" else Scorer(ones, rules).score
    tracemalloc.start()
    try:
        for a in range(0, 480_000, 4000):
            know([" ".join(f"{chr(97 + i % 26)}{i:x}" for i in range(a + k, a + k + 500)) for k in range(0, 4000, 500)])
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 50e6 if learn == "packing" else kept < 30e6

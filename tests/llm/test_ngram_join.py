import random

import numpy as np
import pytest

from periodica.llm.components import components
from periodica.llm.ngram_join import JaccardRules, Trie, deduplicated, near_documents, op8_prefix_tree
from .brute import Groups, jaccard_groups

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def _corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choices(vocab, k=25))
    rows = []
    for i in range(40):
        body = rng.choices(vocab, k=rng.randint(1, 120))
        rows.append(" ".join(body))
        for _ in range(rng.randint(0, 6)):               # near copies, down to below the threshold
            copy = list(body)
            for _ in range(rng.randint(0, 1 + len(copy) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            if rng.random() < 0.3:
                copy = copy[:-rng.randint(1, 1 + len(copy) // 10)] or copy
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
        if rng.random() < 0.4:
            rows.append(passage + " " + " ".join(rng.choices(vocab, k=rng.randint(0, 10))))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,words,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_matches_brute_force(spark, seed, words, percent):
    rows = _corpus(seed)
    rules = JaccardRules(words=words, percent=percent, order_bits=8, block=seed + 1, wide_block=3, stars=1, stray_rounds=seed % 3)
    got = near_documents(spark.createDataFrame(rows, SCHEMA), rules).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_groups(rows, words, percent)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op8_prefix_tree(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_groups(rows, 4, 85)


def test_trie_against_sets():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 30)
        sets = [np.array(sorted(rng.sample(range(n), rng.randint(1, n))), np.uint32) for _ in range(rng.randint(1, 9))]
        probe = np.array(sorted(rng.sample(range(n), rng.randint(1, n))), np.uint32)
        rules = JaccardRules(percent=rng.choice([30, 60, 85, 100]))
        want = [i for i, s in enumerate(sets) if 100 * len(set(s) & set(probe)) >= rules.percent * len(set(s) | set(probe))]
        assert sorted(Trie(sets).matches(probe, n, rules)) == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    g = Groups()
    for a, b in edges:
        if a != b:
            g.union(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: g.find(n) for n in list(g)} and len(got) == len(g)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges(spark, edge, empty, clash):
    got = near_documents(edge).collect()
    assert len(got) == edge.count()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id in (3, 4, 5, 7)} == {
        (3, 0, 3), (4, 0, 4), (5, 0, 5), (7, 1, 7)}
    assert {r.component_id for r in got if r.doc_id in (1, 2, None)} == {1}
    assert near_documents(empty).count() == 0
    assert sorted(map(tuple, near_documents(clash).collect()), key=str) == sorted(map(tuple, got), key=str)
    kept = deduplicated(clash)
    assert kept.columns == clash.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 8]
    assert deduplicated(empty).count() == 0


def test_each_row_goes_with_its_own_group(spark):
    """Near copies without doc_id, and one doc_id with two texts."""
    from periodica.llm.ngram_join import deduplicated
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (None, a + " more"), (None, b), (1, b), (2, a), (2, a), (3, ""), (3, ""), (None, None)]
    kept = deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), JaccardRules(words=5, percent=80)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (1, b), (3, ""), (None, None)], key=str)


def test_a_block_of_long_texts_is_hashed_in_parts():
    """The memory of hashing does not grow with the number of texts in a block."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from periodica.llm.ngram_join import _sets_of_many, ngram_sets
    rules = JaccardRules()
    texts = pa.array([" ".join(f"w{(i * 7 + j) % 977}" for j in range(600)) for i in range(2048)] + [None, "", "one two"])
    tops, found = [], []
    for f in (ngram_sets, _sets_of_many):
        tracemalloc.start()
        found.append(f(texts, rules))
        tops.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    print(tops)
    assert all(np.array_equal(x, y) for x, y in zip(*found))
    assert tops[1] < tops[0] / 2

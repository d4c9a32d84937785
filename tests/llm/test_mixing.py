from collections import Counter, defaultdict

import pytest

from periodica.llm.common import cut
from periodica.llm.mixing import MixRules, mix, mixed_documents, op3_source_mix, permuted, sized, source_targets
from .brute import words

SF = "/root/testdata/sf0.01"


def _targets(sizes, rules):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: rules.weights[i % len(rules.weights)] for i, s in enumerate(names)}
    held, total = {}, rules.share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in held]
        left = total - sum(held.values())
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if t[s] >= rules.most * sizes[s]]
        if not over:
            return held | t
        held |= {s: rules.most * sizes[s] for s in over}
        if len(held) == len(names):
            return held


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_source_mix(spark, SF).collect()
    assert len(rows) == len(docs)
    sizes = defaultdict(int)
    for r in rows:
        assert r.size == len(words(docs[r.doc_id].text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
    want = _targets(sizes, MixRules())
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source] + 1e-6
    assert all(abs(taken[s] - want[s]) < 0.01 * want[s] + 64 for s in want)
    again = op3_source_mix(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 101])
def test_permutation(spark, n):
    from pyspark.sql import functions as F
    got = spark.range(n).select(permuted(F.col("id"), F.lit(n), [F.lit(5), F.lit("s")], 12).alias("x")).collect()
    assert sorted(r.x for r in got) == list(range(n))
    assert n < 64 or [r.x for r in got] != list(range(n))


def test_targets_by_water_level(spark):
    rows = [(i, s, n, 0) for i, (s, n) in enumerate([("b", 1000), ("a", 10), (None, 500), ("c", 0), ("é", 300), ("z", 77)])]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, text_hash long")
    got = {r.source: r.target for r in source_targets(df, MixRules()).collect()}
    want = _targets({s: n for _, s, n, _ in rows}, MixRules())
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_edges(edge, empty, clash):
    rows = mix(edge).collect()
    assert len(rows) == edge.count()
    assert all(r.taken <= 2 * r.size for r in rows)
    assert {r.taken for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0
    assert sorted(map(tuple, mix(clash).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_mixed_documents(edge, clash):
    made = mixed_documents(edge)
    assert made.columns == edge.columns
    taken, got = Counter(), Counter()
    for r in mix(edge).collect():
        taken[r.doc_id] += r.taken
    rows = made.collect()
    for r in rows:
        got[r.doc_id] += len(words(r.text))
    assert +taken == +got
    assert mixed_documents(clash).columns == clash.columns and mixed_documents(clash).count() == len(rows)
    assert cut(sized(edge)).count() == edge.count()

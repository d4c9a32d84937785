import math
import random
import re
from collections import Counter

import numpy as np

from periodica.llm.ranked_search import (Best, Group, Items, SearchRules, build_index, open_index, op11_strata_search,
                                         search)

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}
LAST = 2 ** 63 - 1


def terms(text):
    return TERM.findall((text or "").translate(AZ))


def brute(docs, items, k=10):
    """Counter of (item_id, rank, doc_id, score) for docs (doc_id, text) and items (item_id, text)."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, length = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(terms(text))}
        found = []
        for d, b, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // length
            s = sum(w[t] * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m)) for t in w if b[t])
            if s > 0:
                found.append((-s, LAST if d is None else d))
        for i, (s, d) in enumerate(sorted(found)[:k]):
            out[item, i + 1, None if d == LAST else d, -s] += 1
    return out


def got(df):
    return Counter(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()))


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(op11_strata_search(spark, SF)) == brute(docs, items)


def made(seed, n=400):
    """Documents with few lengths, so that strata are large and ties many."""
    r = random.Random(seed)
    word = lambda: f"w{int(r.paretovariate(0.7)) % 60}"
    docs = [(i, " ".join(word() for _ in range(r.choice((3, 3, 5, 40))))) for i in range(n)]
    docs += [(n + i, "w1 W1, w2-w3") for i in range(n // 2)]
    items = [(i, " ".join(word() for _ in range(6))) for i in range(30)]
    return docs, items


def test_ties_and_parts(spark):
    docs, items = made(1)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for rules in (SearchRules(), SearchRules(k=3, texts=7, part_docs=5, part_postings=20, items=8, group_rows=3, group_docs=16,
                                             slice_postings=50, spread=3)):
        index = build_index(d, rules=rules)
        assert got(search(index, q, rules)) == brute(docs, items, rules.k)
        assert open_index(spark, index.path) == index


def test_bounds_leave_rows_out(spark):
    """The first visits leave most strata unvisited, and no posting's impact beats its bound."""
    docs, items = made(2)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    index = build_index(d, rules=SearchRules(part_docs=8))
    asked = Items([t for _, t in items])
    asked.weights[:] = np.arange(1, len(asked.table) + 1)
    rows = spark.read.parquet(index.path).select("m", "docs", "terms", "starts", "tfs", "places")
    group = Group(rows.toArrow().combine_chunks().to_batches()[0], asked)
    visited = []
    inner = group.start
    class Seen:
        def __getitem__(self, pick):
            visited.append(pick[0].size)
            return inner[pick]
    group.start = Seen()
    best = Best(10)
    group.search(asked.terms[0], asked.weights[asked.terms[0]], best)
    assert len(best.doc) == 10 and sum(visited) < 0.8 * rows.count()
    for t in range(len(asked.table)):
        for r in range(rows.count()):
            own = group.impact[inner[r, t]:inner[r, t] + group.length[r, t]]
            assert not len(own) or own.max() == group.bound[r, t]


def test_edges(spark, edge, empty, clash):
    items = [(1, "cat dog table"), (2, None), (3, ""), (4, "word1 and5 ONE"), (4, "word1 and5 ONE"), (None, "again"), (5, "zzz")]
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute([(r.doc_id, r.text) for r in edge.collect()], items)
    assert got(search(build_index(edge), q)) == want
    assert want[None, 1, None, max(s for i, _, _, s in want if i is None)] == 1
    assert search(build_index(empty), q).count() == 0
    assert search(build_index(edge), q.limit(0)).count() == 0
    assert got(search(build_index(clash), q.selectExpr("*", "1 AS number", "2 AS doc", "3 AS m"))) == want
    odd = [(1, "Ünïcode\x00ünïcode ÜNÏCODE naïve_naïve"), (2, "ünïcode"), (3, "naïve 1st")]
    asked = [(1, "Ünïcode"), (2, "NAïVE 1ST"), (3, "ünïcode")]
    d, q = spark.createDataFrame(odd, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")
    assert got(search(build_index(d), q)) == brute(odd, asked)

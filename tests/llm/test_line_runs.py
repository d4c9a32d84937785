import hashlib
from collections import Counter

from periodica.llm.line_runs import KEY, LineRuns, RunRules, clean_lines, keyed_lines, op12_line_runs
from periodica.session import list_path, unique_path

SF = "/root/testdata/sf0.001"
AZ = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10):
    """(n_lines, n_dropped, kept text) of each (doc_id, text), a null doc_id being the last one."""
    last = 2 ** 63 - 1
    ids = [last if d is None else d for d, _ in rows]
    lines = [(t or "").split("\n") for _, t in rows]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(AZ)
    owner = {}
    for d, ls in sorted(zip(ids, lines), key=lambda x: x[0]):
        for x in ls:
            owner.setdefault(key(x), d)
    kept = [[x for x in ls if len(key(x)) < least or owner[key(x)] == d] for d, ls in zip(ids, lines)]
    return [(d, len(ls), len(ls) - len(k), "\n".join(k)) for (d, _), ls, k in zip(rows, lines, kept)]


def got(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.select("doc_id", "n_lines", "n_dropped", "text").collect())


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = Counter((d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(rows))
    assert Counter(map(tuple, op12_line_runs(spark, SF).collect())) == want
    assert sum(x[2] for x in want) > 0


ROWS = [(5, "A shared line of text\nown five\n\n  a SHARED line of text\t"), (1, "x\nA Shared Line Of Text\nx"),
        (9, "ÉCOLE des beaux arts\nécole des beaux arts"), (2, "École des beaux arts\nécole DES beaux arts\nshort"),
        (7, "short\nshort"), (3, "short"), (4, None), (6, ""), (None, "A shared line of text"), (None, "a null owner's line"),
        (None, "A NULL owner's line"), (8, "K" * 10 + "\n" + "K" * 10), (8, "k" * 10), (10, "k" * 9 + "K")]


def test_batches_and_levels(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    want = Counter(brute(ROWS))
    for rules in (RunRules(batches=1), RunRules(batches=7), RunRules(batches=7, fanout=3)):
        assert got(clean_lines(docs, rules)) == want
    assert want[9, 2, 2, ""] == 1 and want[None, 1, 1, ""] == 1
    assert got(clean_lines(docs, RunRules(least=5))) == Counter(brute(ROWS, 5))


def test_runs_are_kept_merged_and_found_again(spark):
    root, rules = unique_path(spark, "test-runs"), RunRules()
    batches = [[(i, f"line number {i} of all\nline number {i - 1} of all")] for i in range(1, 7)]
    for i, rows in enumerate(batches, 1):
        lines = keyed_lines(spark.createDataFrame(rows, "doc_id long, text string"), rules)
        for _ in range(2):          # as a job would that died after its run was written
            runs = LineRuns(spark, root, rules)
            owners = {r.owner for r in runs.add(lines).collect()}
            assert owners == ({i - 1} if i > 1 else set())
            levels = Counter(r[0] for r in runs.runs)
            assert all(n < rules.fanout for n in levels.values())
            keys = [spark.table(t).count() for _, t, _ in runs.runs]
            assert sum(keys) == i + 1
            runs.close()
    assert len(list_path(spark, root)) <= 4


def test_plan_merges_without_shuffling_runs(spark, capsys):
    runs = LineRuns(spark)
    docs = spark.createDataFrame([(i, f"a line of document {i}\n" + "x" * 30) for i in range(50)], "doc_id long, text string")
    assert runs.add(keyed_lines(docs, RunRules())).count() == 1
    run = spark.table(runs.runs[0][1]).hint("merge")
    keyed_lines(docs, RunRules()).groupBy(*KEY).count().join(run, KEY, "left").explain()
    plan = capsys.readouterr().out
    runs.close(keep=False)
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def test_edges(spark, edge, empty, clash):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    out = clean_lines(edge)
    assert got(out) == Counter(brute(rows))
    assert out.columns == edge.columns + ["n_lines", "n_dropped"]
    assert clean_lines(empty).count() == 0
    more = clean_lines(clash)
    assert got(more) == got(out) and more.columns == clash.columns + ["n_lines", "n_dropped"]
    assert {r.place for r in clean_lines(clash.withColumns({"place": clash.lang, "doc": clash.lang})).collect()} == {"en", None}

from collections import defaultdict

from periodica.llm.quality_lines import LineRules, cleaned, op5_quality_lines, quality
from .brute import base, line_key, words

SF = "/root/testdata/sf0.001"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _holders(rows):
    """Documents that hold each line of a host, by number of the row."""
    held = defaultdict(set)
    for i, (source, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if words(line):
                held[source, line_key(line)].add(i)
    return held


def test_base_measures(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op5_quality_lines(spark, SF).collect()
    assert {r.doc_id: tuple(r[c] for c in BASE) for r in got} == {d: base(t) for d, t in docs.items()}


def _corpus():
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    rows = []
    for i in range(12):
        rows.append((i, f"Cookies help us deliver our services every day.\n{body(i)}", "h1"))      # loses one line
        rows.append((100 + i, f"COOKIES  help us deliver our services every day.\nPlease accept all of the terms and conditions "
                              f"before you go on reading any of this page\nx{i} y{i}", "h1"))       # hardly anything else
    rows += [(200 + i, f"Cookies help us deliver our services every day.\n{body(200 + i)}", "h2") for i in range(3)]
    # copies count each, and as first holders of their lines they all keep them
    rows += [(300 + i, "The same copied document, " + body(300), "h1") for i in range(40)]
    # hardly more than a line that copies hold, which makes it common
    rows += [(400, "The same copied document, " + body(300) + "\nwith three more", "h1")]
    return rows


def test_line_frequency(spark):
    rules = LineRules(max_docs=5)
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality(docs, rules).collect()}
    held = _holders([(r[2], r[1]) for r in _corpus()])
    common = {k for k, v in held.items() if len(v) > 5}
    assert {k[1] for k in common} == {"cookies help us deliver our services every day.", line_key(_corpus()[-2][1]),
                                      "please accept all of the terms and conditions before you go on reading any of this page"}
    lost = [d for d, r in got.items() if r.lines_removed]
    assert all(got[200 + i].kept and not got[200 + i].lines_removed for i in range(3))
    assert len({got[300 + i].lines_removed for i in range(40)}) == 1
    assert all(got[i].kept for i in range(12))
    # the dealt rule rejects documents that the base rules keep
    assert sum(not got[100 + i].kept for i in range(12)) in (10, 11, 12)
    assert not any(got[100 + i].base_failed for i in range(12))
    # the first holder of a line keeps it: the copies, or the one text that has three words more
    assert got[400].lines_removed + got[300].lines_removed == 1 and got[400].kept != bool(got[400].lines_removed)
    assert len([d for d in lost if d < 300]) in (22, 23)
    for d in lost:
        n = sum(len(words(x)) for x in dict((a, b) for a, b, _ in _corpus())[d].split("\n") if ("h1", line_key(x)) in common)
        assert got[d].words_left >= 1 - n / got[d].n_words - 1e-9


def test_cleaned(spark):
    rules = LineRules(max_docs=5)
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality(docs, rules).collect() if r.kept}
    out = {r.doc_id: r.text for r in cleaned(docs, rules).collect()}
    assert set(out) == kept
    assert sum("ookies" in out[i] for i in range(12)) <= 1 and all("w3x0" in out[3] for _ in (1,))


def test_edges(edge, empty, clash):
    got = quality(edge).collect()
    assert len(got) == edge.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for d, text in [(r.doc_id, r.text) for r in edge.collect()]:
        assert tuple(by[d][0][c] for c in BASE) == base(text)
    assert not by[3][0].kept and not by[4][0].kept and not by[8][0].kept and by[6][0].kept
    assert quality(empty).count() == 0 and cleaned(empty).columns == empty.columns
    same = quality(clash).collect()
    assert sorted(map(tuple, same), key=str) == sorted(map(tuple, got), key=str)
    assert cleaned(clash).columns == clash.columns and cleaned(clash).count() == sum(r.kept for r in got)


def test_limit_grows_with_the_host(spark):
    """A line of 4 % of a host's documents stays and one of 30 % goes, at any size; so on a null host."""
    def doc(i, n):
        held = ["Les."] * (i < 0.04 * n) + ["Cookies help us deliver our services every day."] * (i >= 0.7 * n)
        return "\n".join(held + [" ".join(f"w{i}x{j}" for j in range(30))])
    for n in (100, 1000):
        rows = [(1000 * h + i, doc(i, n), host) for h, host in enumerate(("h1", None)) for i in range(n)]
        got = {r.doc_id: r for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
        for h in (0, 1000):
            assert not any(got[h + i].lines_removed for i in range(int(0.7 * n)))
            assert sum(got[h + i].lines_removed for i in range(int(0.7 * n), n)) == 0.3 * n - 1
        assert all(r.kept for r in got.values())

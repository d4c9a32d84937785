import pytest

from periodica.llm.url_lists import ListRules, OP4_SQL, intervals, op4_temporal_lists, temporal_verdicts

SF = "/root/testdata/sf0.01"
CAPTURES = "page_id long, url string, fetch_day int"
ENTRIES = "list string, key string, day int, action string"


def test_query_matches_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(OP4_SQL)
    names = [d[0] for d in want.description]
    rows = want.fetchall()
    assert sorted(map(tuple, op4_temporal_lists(spark, SF).select(*names).collect()), key=str) == sorted(rows, key=str)
    assert len({r[names.index("verdict")] for r in rows}) == 3


def test_as_of(spark):
    entries = spark.createDataFrame([
        ("deny", "example.com", 10, "add"), ("deny", "example.com", 50, "remove"), ("deny", "example.com", 95, "add"),
        ("allow", "www.example.com", 20, "add"), ("deny", "www.example.com/x", 30, "add"), ("deny", "www.example.com", 40, "add"),
        ("deny", "example.com", 10, "add"), ("deny", "one.org", 5, "add"), ("deny", "one.org", 5, "remove"), ("deny", None, 1, "add")], ENTRIES)
    days = [0, 10, 20, 35, 40, 49, 50, 94, 95, 400]
    caps = [(d, "https://www.example.com:8080/x/y?q#f", d) for d in days] + [(1000 + d, "http://sub.example.com", d) for d in days]
    caps += [(2000, None, 5), (2001, "nonsense", 5), (2002, "http://example.com/", None), (2003, "http://one.org/", 7), (2004, "http://EXAMPLE.com", 12)] * 2
    got = temporal_verdicts(spark.createDataFrame(caps, CAPTURES), entries, ListRules(bucket_days=7)).collect()
    assert len(got) == len(caps)
    by = {r.page_id: r for r in got}
    assert [by[d].verdict for d in days] == ["unlisted", "deny", "allow", "deny", "deny", "deny", "deny", "deny", "deny", "deny"]
    assert by[35].matched_key == "www.example.com/x" and by[35].n_active == 3 and by[35].listed_since == 30
    assert [by[1000 + d].verdict for d in days] == ["unlisted", "deny", "deny", "deny", "deny", "deny", "unlisted", "unlisted", "deny", "deny"]
    assert [by[i].verdict for i in range(2000, 2005)] == ["unlisted"] * 4 + ["deny"]


def test_edges(spark):
    entries = spark.createDataFrame([("deny", "a.b", 1, "add")], ENTRIES)
    none = spark.createDataFrame([], CAPTURES)
    assert temporal_verdicts(none, entries).count() == 0
    caps = spark.createDataFrame([(1, "http://a.b", 3, "x", 1)], CAPTURES + ", host string, keys int")
    assert temporal_verdicts(caps, spark.createDataFrame([], ENTRIES)).collect()[0].verdict == "unlisted"
    assert temporal_verdicts(caps, entries).collect()[0].verdict == "deny"
    assert intervals(entries).collect()[0].valid_to is None

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from periodica.llm.common import cut, ship
from periodica.llm.prefix_trie import TrieRules, numbered, op13_prefix_trie, rebuilt, trie_nodes, turns_of

SF = "/root/testdata/sf0.001"
CONVS = "conv_id long, turn long, role string, text string"


def brute_nodes(lists):
    """The nodes of {conv: list of turns (role, text)}."""
    at = defaultdict(list)
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            at[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in at if p)
    leaves, saved = Counter(), Counter()
    for p, members in at.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, members in at.items():
        ends = ",".join(str(c) for c in sorted(members) if len(lists[c]) == len(p))
        out.append((min(members), len(p), min(at[p[:-1]]) if p else None, len(members), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h[c]] + own[c][h[c]:] for c in own}


def got(df):
    return Counter(map(tuple, df.collect()))


def nodes(spark, rows, rules=TrieRules()):
    ship(spark)
    return got(trie_nodes(*rebuilt(cut(turns_of(spark.createDataFrame(rows, CONVS)))), rules))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_prefix_trie(spark, SF)) == brute_nodes(brute_rebuilt(rows))


def made(seed, convs=60, longest=23):
    """Conversations that part at random places, with nulls, ties of nothing and negative ids."""
    r, rows = random.Random(seed), []
    for c in range(-convs // 3, convs):
        like = r.choice((0, 1, 1, 1, 2))
        n = r.randrange(1, longest)
        for i in range(n):
            own = i >= r.randrange(1, 40)
            rows.append((c, i if i else None, r.choice(("user", None)) if own else "user",
                         f"é{c % 7}.{i}" if own else (f"{like}.{i}" if i % 6 else None)))
    return rows


def test_blocks_of_any_length(spark):
    for seed, rules in ((1, TrieRules()), (2, TrieRules(block=1, span=2, heavy=3)), (3, TrieRules(block=3, span=1, heavy=10 ** 6, chunk=2)),
                        (4, TrieRules(block=64))):
        rows = made(seed)
        want = brute_nodes(brute_rebuilt(rows))
        assert nodes(spark, rows, rules) == want


def test_agreeing_blocks_are_walked_once(spark):
    """A long conversation, a third of all rows, and many copies of another."""
    rows = [(1, i, "user", f"t{i}") for i in range(700)] + [(c, i, "user", f"s{i}") for c in range(5, 405, 5) for i in range(17)]
    assert nodes(spark, rows) == brute_nodes(brute_rebuilt(rows))


def test_places_over_partitions(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 11).alias("g"), (-F.col("id")).alias("o"))
    found = numbered(rows, "g", ["o"], "at").collect()
    by = defaultdict(list)
    for x in found:
        by[x.g].append((x.o, x["at"]))
    for v in by.values():
        assert [a for _, a in sorted(v)] == list(range(len(v)))


def test_edges(spark):
    assert nodes(spark, []) == Counter()
    rows = [(None, 0, "user", "lost"), (3, None, None, None), (3, None, None, None), (3, 0, "user", ""), (10, 0, None, "x" * 300_000),
            (10, 0, None, "x" * 300_000), (11, 5, "user", "a"), (12, 5, "user", "a")]
    want = brute_nodes(brute_rebuilt(rows))
    assert nodes(spark, rows) == want
    one = [(4, 0, "user", "only")]          # rebuilt to nothing: no base, and h is past its turn
    assert nodes(spark, one) == brute_nodes(brute_rebuilt(one))
    more = spark.createDataFrame(rows, CONVS).withColumns({c: F.lit("x") for c in ("at", "t1", "conv", "bytes", "n", "b")})
    assert got(trie_nodes(*rebuilt(cut(turns_of(more))))) == want

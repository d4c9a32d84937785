"""Operator 8: n-gram Jaccard join over prefix trees.

A document's set holds its distinct word n-grams as 64-bit hashes, in one global
order: rare first, where rarity is the number of documents in a hash bucket of
the n-gram (counted over the whole corpus in a table of fixed size), ties by
hash. Documents with equal sets are one class. Sets that reach similarity t
share an n-gram among their first ``n - ceil(t n) + 1``; so

1. classes meet at the n-grams of these prefixes;
2. every class is compared, at a few of its shared n-grams, with one class chosen
   there, and then each class that is outside the largest component at one of its
   n-grams with a few of that component: this joins groups of near copies
   without listing their pairs;
3. every pair of classes that meet and are still in different components is a
   candidate unless sizes, places of the n-gram or counts of shared n-grams prove
   that it is below t, and every candidate is compared.

Comparisons run over prefix trees: the sets to compare with a probe are stored in
a trie in the same global order (common first, so that they share paths); the
probe descends it, a shared path is intersected once for all sets below, and a
subtree is left as soon as the n-grams that remain cannot reach t.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import cut, put_back, read, set_aside, ship
from periodica.llm.components import Forest, components
from periodica.llm.word_hashes import K1, S32, mixed, word_hashes
from periodica.session import delete_path, unique_path

SLICES = 16


@dataclass(frozen=True)
class JaccardRules:
    words: int = 4           # of an n-gram
    percent: int = 85        # similarity
    order_bits: int = 21     # the order table has 2 ** order_bits counts
    stray_rounds: int = 1
    probes: int = 8          # of a block of stars, besides its first; pairs of a stray class
    stars: int = 2           # n-grams of a class at which it is compared first
    block: int = 128         # sets of a trie of pairs; where more pairs than its square meet, blocks do
    wide_block: int = 1024   # sets of such a block's trie, and its probes
    broadcast_rows: int = 500_000   # of 16 bytes; more are joined by a shuffle
    texts: int = 256         # texts hashed together

    def least(self, n: int) -> int:
        """Smallest intersection that a set of n needs with any set."""
        return -(-self.percent * n // 100)


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])      # white space parts words


def ngram_sets(texts: pa.Array, rules: JaccardRules,
               counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All sets in one array, each in the global order (by hash without ``counts``), and their sizes.

    A-Z are lower-cased. A text of fewer words than an n-gram has its whole
    sequence as its one n-gram; a text without words, or null, an empty set.
    """
    h, doc, n = word_hashes(texts, SPACE)
    start = np.cumsum(n) - n
    k = rules.words
    # a window of the next k words; of short texts, the first window holds what there is
    place = np.arange(len(h)) - start[doc]
    at = np.flatnonzero((place <= n[doc] - k) | ((place == 0) & (n[doc] < k)))
    length = np.minimum(n[doc[at]], k)
    g = length.astype(np.uint64) * K1
    for i in range(k):
        nxt = (g ^ (g >> S32)) * K1 + h[np.minimum(at + i, max(len(h) - 1, 0))]
        g = nxt if (length > i).all() else np.where(length > i, nxt, g)
    g = mixed(g)
    found, ends = [], np.cumsum(np.bincount(doc[at], minlength=len(n)))
    a = 0
    for b in ends.tolist():
        s = np.unique(g[a:b])
        found.append(s if counts is None else s[np.argsort(counts[_bucket(s, rules)], kind="stable")])
        a = b
    sizes = np.array([len(s) for s in found], np.int64)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), sizes


def _sets_of_many(texts: pa.Array, rules: JaccardRules) -> tuple[np.ndarray, np.ndarray]:
    """``ngram_sets`` of a block's texts, a few at a time: hashing takes many times a text's own memory."""
    parts = [ngram_sets(texts.slice(a, rules.texts), rules) for a in range(0, len(texts), rules.texts)]
    return np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts])


def _bucket(g: np.ndarray, rules: JaccardRules) -> np.ndarray:
    return (g & np.uint64(2 ** rules.order_bits - 1)).astype(np.int64)


def _classes_of(g: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit id of each set, the same whatever its order."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(g ^ K1), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return mixed((total[ends] - total[ends - sizes]) ^ (sizes.astype(np.uint64) * K1)).view(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, n):
            yield b.slice(a, n)


def _signed(docs: DataFrame, rules: JaccardRules) -> DataFrame:
    """Per document (doc_id, h, n, cid); and, per task and slice, packed bucket counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 ** rules.order_bits, np.uint32)
        names = ["doc_id", "h", "n", "cid", "slice", "counts"]
        for b in _chunks(batches, rules.texts):
            g, sizes = ngram_sets(b.column(2), rules)
            np.add.at(counts, _bucket(g, rules), 1)
            none = pa.nulls(b.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes), pa.array(_classes_of(g, sizes)), none,
                                              pa.nulls(b.num_rows, pa.binary())], names=names)
        if counts.any():
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SLICES)]
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(SLICES), pa.int32()),
                                              pa.array(parts, pa.binary())], names=names)
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        run, "doc_id long, h long, n long, cid long, slice int, counts binary")


def _order_table(signed: DataFrame, rules: JaccardRules) -> Broadcast:
    """The bucket counts of the whole corpus: 2 ** order_bits numbers, whatever its size."""
    width = 2 ** rules.order_bits // SLICES

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(width, np.uint64)
        for x in t.column("counts"):
            total += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
        return pa.table({"slice": pa.array([t.column("slice")[0].as_py()], pa.int32()),
                         "counts": pa.array([zlib.compress(np.minimum(total, 2 ** 32 - 1).astype(np.uint32).tobytes(), 1)], pa.binary())})
    parts = (signed.filter(F.col("slice").isNotNull()).select("slice", "counts")
             .groupBy("slice").applyInArrow(add, "slice int, counts binary").collect())
    table = np.zeros(2 ** rules.order_bits, np.uint32)
    for r in parts:
        table[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return signed.sparkSession.sparkContext.broadcast(table)


def _prefixes(docs: DataFrame, order: Broadcast, rules: JaccardRules) -> DataFrame:
    """(token, cid, n, place) for the n-grams of each set's prefix, once for each class and
    task: a class of any number of copies has as many rows at an n-gram as there are tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for b in _chunks(batches, rules.texts):
            g, sizes = ngram_sets(b.column(0), rules, order.value)
            cids = _classes_of(g, sizes)
            fresh = np.zeros(len(cids), bool)
            fresh[np.unique(cids, return_index=True)[1]] = True
            fresh &= ~np.isin(cids, seen)
            seen = np.append(seen, cids[fresh])
            keep = np.where(fresh & (sizes > 0), sizes - (-(-rules.percent * sizes // 100)) + 1, 0)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(g)) - (np.cumsum(sizes) - sizes)[owner]
            m = place < keep[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[m].view(np.int64)), pa.array(cids[owner[m]]), pa.array(sizes[owner[m]].astype(np.int32)),
                 pa.array(place[m].astype(np.int32))], names=["token", "cid", "n", "place"])
    return docs.select("text").mapInArrow(run, "token long, cid long, n int, place int")


def _shared(prefixes: DataFrame, rules: JaccardRules) -> DataFrame:
    """(token, cid, n, place, shared): the n-grams at which classes meet that may reach t.

    A class stays at an n-gram if the class of the nearest size there is near enough, and
    where only two classes are left, if these two can reach t. ``shared`` counts a
    class's n-grams after the first of these rules: no pair that reaches t has more in
    common in its prefixes, as it meets at each of them."""
    token = Window.partitionBy("token")
    rows = (prefixes.select("*", F.min("cid").over(token).alias("_lo"), F.max("cid").over(token).alias("_hi"))
            .filter("_lo <> _hi").groupBy("token", "cid").agg(F.first("n").alias("n"), F.first("place").alias("place")))
    by_size = token.orderBy("n", "cid")
    rows = rows.select("*", F.lag("n").over(by_size).alias("_below"), F.lead("n").over(by_size).alias("_above"))
    rows = rows.filter(f"100 * _below >= {rules.percent} * n OR 100 * n >= {rules.percent} * _above")
    rows = cut(rows.select("token", "cid", "n", "place", F.count("*").over(Window.partitionBy("cid")).alias("shared")))
    by_cid, one = token.orderBy("cid"), F.struct("n", "place", "shared")
    pairs = rows.select("token", "cid", one.alias("x"), F.count("*").over(token).alias("_k"),
                        F.coalesce(F.lag(one).over(by_cid), F.lead(one).over(by_cid)).alias("y"))
    return cut(pairs.filter((F.col("_k") > 2) | _possible("x", "y", rules)).select("token", "cid", "x.*"))


def _texts(docs: DataFrame, wanted: DataFrame, rules: JaccardRules, place: str) -> str:
    """A table of (cid, text), bucketed by cid in the folder ``place``: a text of each wanted
    class (doc_id, cid); a repeated doc_id may give one twice. Texts are dealt by cid
    once, and every comparison reads them where they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in _chunks(batches, rules.texts):
            cids = b.column(0).to_numpy()
            ok = [i for i in np.flatnonzero(_classes_of(*ngram_sets(b.column(1), rules)) == cids).tolist()
                  if int(cids[i]) not in seen]
            seen.update(cids[ok].tolist())
            yield b.take(pa.array(ok, pa.int64()))
    spark = docs.sparkSession
    wanted = cut(wanted.select(F.col("doc_id").alias("_w"), "cid"))
    if wanted.count() <= rules.broadcast_rows:
        wanted = F.broadcast(wanted)
    rows = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_w"))).select("cid", "text")
    parts, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"ngram_texts_{uuid.uuid4().hex}"
    (rows.mapInArrow(run, "cid long, text string").repartition(parts, "cid")
     .write.bucketBy(parts, "cid").option("path", place).saveAsTable(table))
    return table


def _no_place() -> list[Column]:
    return [F.lit(None).cast("int").alias("place"), F.lit(None).cast("long").alias("shared")]


class Trie:
    """Sets as sorted rank rows: rows that begin alike lie together, so a node of the
    prefix tree is a range of rows with a common prefix; paths are compressed."""

    def __init__(self, rows: list[np.ndarray]):
        self.order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">u4").tobytes())
        self.rows = [rows[i] for i in self.order]
        self.sizes = np.array([len(r) for r in self.rows], np.int64)

    def matches(self, probe: np.ndarray, universe: int, rules: JaccardRules, only: np.ndarray | None = None) -> list[int]:
        """Numbers of the stored sets (of those marked in ``only``) that reach the threshold."""
        upto = np.arange(len(self.rows) + 1) if only is None else np.append(0, np.cumsum(only[self.order]))
        inside = np.zeros(universe + 1, bool)
        inside[probe] = True
        pct, nx, found = rules.percent, len(probe), []
        todo = [(0, len(self.rows), 0, 0)] if self.rows else []
        while todo:
            lo, hi, depth, overlap = todo.pop()
            if upto[lo] == upto[hi]:
                continue
            first, last = self.rows[lo], self.rows[hi - 1]
            if hi - lo == 1:
                end = len(first)
            else:
                m = min(len(first), len(last))
                differ = np.flatnonzero(first[depth:m] != last[depth:m])
                end = depth + int(differ[0]) if len(differ) else m
            overlap += int(inside[first[depth:end]].sum())
            # what can still be shared: the rest of the longest set, and of the probe
            size = self.sizes[lo:hi]
            after = nx - int(np.searchsorted(probe, first[end - 1], "right")) if end else nx
            most = overlap + min(int(size.max()) - end, after)
            if (100 + pct) * most < pct * (nx + int(size.min())):
                continue
            if hi - lo == 1:
                found.append(self.order[lo])
                continue
            if len(first) == end:                       # sets that end here come first
                done = lo
                while done < hi and len(self.rows[done]) == end:
                    if upto[done] < upto[done + 1] and (100 + pct) * overlap >= pct * (nx + end):
                        found.append(self.order[done])
                    done += 1
                lo = done
            step = np.array([self.rows[i][end] for i in range(lo, hi)])
            cuts = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), hi - lo]
            todo += [(lo + a, lo + b, end, overlap) for a, b in zip(cuts, cuts[1:]) if b > a]
        return found


def _reachable(i: int, n: np.ndarray, place: np.ndarray, shared: np.ndarray, rules: JaccardRules) -> np.ndarray:
    """``_possible`` for row i of a block with all its rows."""
    p = rules.percent
    need = -(-p * (n[i] + n) // (100 + p))
    hi = np.maximum(n[i], n)
    return ((100 * np.minimum(n[i], n) >= p * hi) & (place[i] <= n[i] - need) & (place <= n - need)
            & (np.minimum(shared[i], shared) - (-p * hi // 100) - 1 >= need))


def _compare(pairs: DataFrame, texts: DataFrame, order: Broadcast, rules: JaccardRules, more: int = 0) -> DataFrame:
    """Links (a, b) of distinct pairs (x, y): the partners y of a probe x are dealt into blocks."""
    blocks = pairs.groupBy("x").agg(F.ceil(F.count("*") / rules.block).alias("k"))
    dealt = pairs.join(blocks, "x").select(
        "x", F.pmod(F.xxhash64("y"), F.col("k")).alias("part"), F.col("y").alias("cid"), F.col("y").alias("root"),
        F.lit(False).alias("probe"), *_no_place())
    probes = dealt.select("x", "part").distinct().select(
        "x", "part", F.col("x").alias("cid"), F.col("x").alias("root"), F.lit(True).alias("probe"), *_no_place())
    return _tries(dealt.unionByName(probes), texts, order, rules, more)


def _tries(rows: DataFrame, texts: DataFrame, order: Broadcast, rules: JaccardRules, more: int = 0) -> DataFrame:
    """Links (a, b) between the probes and the classes of each block (x, part), as a spanning
    forest. A block's classes are a trie; those of one root are linked already, and a
    probe is not compared once all are linked with it. With ``more``, up to so many
    classes become probes too, each one that no link has joined to the largest group.
    Rows that met at an n-gram carry its ``place`` and their ``shared`` count, and a
    probe then descends only to the classes that these do not rule out."""
    work = rows.join(texts, "cid")

    def run(t: pa.Table) -> pa.Table:
        g, sizes = _sets_of_many(t.column("text").combine_chunks(), rules)
        cids, probe, root = t.column("cid").to_pylist(), t.column("probe").to_pylist(), t.column("root").to_pylist()
        met = t.column("place").null_count == 0
        place, shared = (t.column(c).to_numpy() if met else None for c in ("place", "shared"))
        every = np.unique(g)
        rank = np.empty(len(every), np.uint32)          # common first
        rank[np.lexsort((every, order.value[_bucket(every, rules)]))[::-1]] = np.arange(len(every), dtype=np.uint32)
        sets = [np.sort(rank[np.searchsorted(every, s)]) for s in np.split(g, np.cumsum(sizes)[:-1])]
        trie, joined, links, first = Trie(sets), Forest(len(sets)), [], {}
        for i, r in enumerate(root):
            joined.union(first.setdefault(r, i), i)
        todo, asked = [i for i, p in enumerate(probe) if p], set()
        for _ in range(len(todo) + more):
            if not todo:
                largest = Counter(map(joined.find, range(len(sets)))).most_common(1)[0][0]
                todo = [i for i in range(len(sets)) if i not in asked and joined.find(i) != largest][:1]
                if not todo:
                    break
            i = todo.pop()
            asked.add(i)
            only = np.array([joined.find(m) != joined.find(i) for m in range(len(sets))])
            if place is not None:
                only &= _reachable(i, sizes, place, shared, rules)
            links += [(cids[i], cids[m]) for m in trie.matches(sets[i], len(every), rules, only) if joined.union(i, m)]
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})
    return work.groupBy("x", "part").applyInArrow(run, "a long, b long")


def _with_roots(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("cid"))
    r = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    return (rows.join(r, F.col("cid") == F.col("_n"), "left")
            .withColumn("root", F.coalesce("_r", "cid")).drop("_n", "_r"))


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots after more links, whose ends are first replaced by the roots so far."""
    if roots is None:
        return cut(components(links))
    a = _with_roots(links.select(F.col("a").alias("cid"), "b"), roots).select(F.col("root").alias("a"), F.col("b").alias("cid"))
    more = cut(components(_with_roots(a, roots).select("a", F.col("root").alias("b"))))
    old = roots.join(more.select(F.col("node").alias("_m"), F.col("root").alias("_t")), F.col("root") == F.col("_m"), "left")
    old = old.select("node", F.coalesce("_t", "root").alias("root"))
    return cut(old.unionByName(more.join(old.select(F.col("node").alias("_o")), F.col("node") == F.col("_o"), "left_anti")))


def _star_pairs(shared: DataFrame, rules: JaccardRules) -> DataFrame:
    """Each class with the class chosen at a few of its shared n-grams."""
    few = (shared.groupBy("cid").agg(F.first("n").alias("n"), F.slice(F.sort_array(F.collect_list(
        F.struct(F.xxhash64("token").alias("h"), "token"))), 1, rules.stars).alias("t"))
        .select("cid", "n", F.explode("t.token").alias("token")))
    # classes of like size meet; the band is only a choice of whom to try first
    few = few.withColumn("band", F.floor(F.log(F.col("n")) * 4))
    chosen = few.groupBy("token", "band").agg(F.min_by("cid", F.xxhash64("cid")).alias("x"))
    met = few.join(chosen, ["token", "band"]).filter(F.col("cid") != F.col("x"))
    return met.select("x", F.col("cid").alias("y")).distinct()


def _possible(a: str, b: str, rules: JaccardRules) -> Column:
    """Whether rows a and b of an n-gram (n, place, shared) can be of sets that reach t.

    t demands ``need`` n-grams in common, so such sets share one among their first
    ``n - need + 1``, and only there they need to meet; and with all n-grams common to
    their prefixes, and the ceil(t n) - 1 beyond, they must come to ``need``."""
    p, x, y = F.lit(rules.percent), F.col(f"{a}.n"), F.col(f"{b}.n")
    hi, need = F.greatest(x, y), F.ceil(p * (x + y) / (100 + p))
    return ((100 * F.least(x, y) >= p * hi) & (F.col(f"{a}.place") <= x - need) & (F.col(f"{b}.place") <= y - need)
            & (F.least(f"{a}.shared", f"{b}.shared") + F.ceil(p * hi / 100) - 1 >= need))


def _mixed_tokens(shared: DataFrame, roots: DataFrame | None, salts: tuple[int, ...] = ()) -> DataFrame:
    """The shared n-grams at which several components meet: all rows, with the component
    that has most classes there (``major``) and, for each salt, one class of it."""
    rows = _with_roots(shared, roots)
    ends = rows.groupBy("token").agg(F.min("root").alias("_a"), F.max("root").alias("_z")).filter("_a <> _z").select("token")
    rows = cut(rows.join(ends, "token", "left_semi"))
    one = F.struct("cid", "n", "place", "shared")
    per = rows.groupBy("token", "root").agg(
        F.count("*").alias("k"), *[F.min_by(one, F.xxhash64(F.lit(i), F.col("cid"))).alias(f"c{i}") for i in salts])
    best = F.struct("k", "root")
    major = (per.groupBy("token").agg(F.max_by("root", best).alias("major"), F.sum("k").alias("all"), F.max("k").alias("inside"),
                                      F.max_by(F.array(*[f"c{i}" for i in salts]) if salts else F.lit(None), best).alias("some")))
    return rows.join(major, "token")


def _stray_pairs(shared: DataFrame, roots: DataFrame, salt: int, rules: JaccardRules) -> DataFrame:
    """A few pairs of each class outside the major component of its n-grams with classes inside."""
    rows = _mixed_tokens(shared, roots, tuple(range(salt, salt + 4))).filter("root <> major")
    met = rows.select(F.struct("cid", "n", "place", "shared").alias("y"), F.explode("some").alias("x"))
    met = met.filter(_possible("x", "y", rules)).select(F.col("x.cid").alias("x"), F.col("y.cid").alias("y")).distinct()
    order = Window.partitionBy("y").orderBy(F.xxhash64("x", "y"))
    return met.withColumn("_i", F.row_number().over(order)).filter(F.col("_i") <= rules.probes).select("x", "y")


def _open(shared: DataFrame, roots: DataFrame, rules: JaccardRules) -> tuple[DataFrame, DataFrame]:
    """What is left to compare: pairs (x, y), and blocks of rows (x, part, cid, root, probe).

    At an n-gram, the component with most classes there is set against the others,
    and these against each other: no pair inside a component is ever made. Where few
    classes meet, these are the pairs that sizes, places and counts cannot rule out.
    Where many do, the classes outside are dealt into blocks as probes, and all into
    blocks as tries, and every block of probes meets every trie: rows grow with the
    classes and the number of blocks, not with the pairs."""
    row = F.struct("cid", "n", "place", "shared", "root")
    outside = F.col("all") - F.col("inside")
    mixed = _mixed_tokens(shared, roots).select("token", "root", "major", "all", outside.alias("out"), row.alias("r"))
    small = mixed.filter(F.col("out") * F.col("all") <= rules.block ** 2)
    left = small.filter("root <> major").select("token", F.col("r").alias("x"))
    right = small.select("token", "major", F.col("r").alias("y"))
    met = (left.join(right, "token").filter(F.col("x.root") != F.col("y.root"))
           .filter((F.col("y.root") == F.col("major")) | (F.col("x.cid") < F.col("y.cid")))
           .filter(_possible("x", "y", rules)))
    pairs = met.select(F.least("x.cid", "y.cid").alias("x"), F.greatest("x.cid", "y.cid").alias("y")).distinct()

    large = mixed.filter(F.col("out") * F.col("all") > rules.block ** 2)
    probes, tries = F.ceil(F.col("out") / rules.wide_block), F.ceil(F.col("all") / rules.wide_block)
    mine = F.xxhash64("r.cid")

    def dealt(own: Column, others: Column, code: Column, d: DataFrame, probe: bool) -> DataFrame:
        d = d.select("token", F.pmod(mine, own).alias("_own"), F.explode(F.sequence(F.lit(0), others - 1)).alias("_other"), "r", "all")
        return d.select(F.col("token").alias("x"), code.alias("part"), F.col("r.cid").alias("cid"), F.col("r.root").alias("root"),
                        F.lit(probe).alias("probe"), F.col("r.place").alias("place"), F.col("r.shared").alias("shared"))
    wide = F.lit(1 << 24)
    blocks = dealt(probes, tries, F.col("_own") * wide + F.col("_other"), large.filter("root <> major"), True).unionByName(
        dealt(tries, probes, F.col("_other") * wide + F.col("_own"), large, False))
    return pairs, blocks


def _grouped(docs: DataFrame, rules: JaccardRules, doc_id: str, text: str) -> DataFrame:
    """doc_id, h (hash of the text), n, component_id, and whether the row is the one that
    names its group (``first``)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = cut(_signed(docs, rules))
    order = _order_table(signed, rules)
    rows = signed.filter(F.col("slice").isNull()).select("doc_id", "h", "n", "cid")
    full = rows.filter("n > 0")
    shared = _shared(_prefixes(docs, order, rules), rules)
    wanted = full.join(shared.select("cid").distinct(), "cid", "left_semi").groupBy("cid").agg(F.min("doc_id").alias("doc_id"))
    place = unique_path(docs.sparkSession, "ngram-texts")
    table = _texts(docs, wanted, rules, place)
    texts = docs.sparkSession.table(table)
    roots = _merged(None, cut(_compare(cut(_star_pairs(shared, rules)), texts, order, rules, rules.probes)))
    for r in range(rules.stray_rounds):
        pairs = cut(_stray_pairs(shared, roots, 10 * r, rules))
        roots = _merged(roots, cut(_compare(pairs, texts, order, rules)))
    pairs, blocks = _open(shared, roots, rules)
    links = _compare(cut(pairs), texts, order, rules).unionByName(_tries(blocks, texts, order, rules))
    roots = _merged(roots, cut(links))
    docs.sparkSession.sql(f"DROP TABLE {table}")        # all comparisons are made and cut
    delete_path(docs.sparkSession, place)
    order.destroy()
    known = _with_roots(full.groupBy("cid").agg(F.min("doc_id").alias("low")), roots)
    order_of = F.struct(F.col("low").isNull().alias("none"), "low", "cid")
    lows = known.groupBy("root").agg(F.min("low").alias("component"), F.min_by("cid", order_of).alias("_first")).withColumnRenamed("root", "_root")
    known = known.join(lows, F.col("root") == F.col("_root")).select(
        F.col("cid").alias("_c"), "component", "low", (F.col("cid") == F.col("_first")).alias("_names"))
    return (rows.join(known, (F.col("cid") == F.col("_c")) & (F.col("n") > 0), "left")
            .select("doc_id", "h", "n", F.when(F.col("_c").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                    (F.col("_c").isNull() | (F.col("_names") & F.col("doc_id").eqNullSafe(F.col("low")))).alias("first")))


def near_documents(docs: DataFrame, rules: JaccardRules = JaccardRules(), doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    A null or empty text links with nothing and names itself; equal rows are
    copies of each other; a null doc_id never names a component unless all of the
    component's are null; whole texts are read, whatever their length; an empty
    table gives no rows; further columns are ignored.
    """
    return _grouped(docs, rules, doc_id, text).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def deduplicated(docs: DataFrame, rules: JaccardRules = JaccardRules()) -> DataFrame:
    """One document of each group: that of the smallest doc_id, a null one only where the
    group has no other. Equal rows become one; of one doc_id with several texts, each
    goes with its own group."""
    found = _grouped(docs, rules, "doc_id", "text")
    kept = found.filter("first").select(F.col("doc_id").alias("_k"), F.col("h").alias("_kh")).distinct()
    keep = ["doc_id", "text"]
    rows = set_aside(docs, keep).withColumn("_h", F.xxhash64("text"))
    rows = rows.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_k")) & (F.col("_h") == F.col("_kh")), "left_semi")
    return put_back(rows.dropDuplicates(["doc_id", "_h"]), docs.columns, keep)


def op8_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: groups of similarity 0.85 on 4-word shingles."""
    return near_documents(read(spark, sf_dir, "documents"))

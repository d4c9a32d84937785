"""Operator 11: ranked lexical search over a length-stratified index.

A document's score depends on its length only through the normaliser m, a whole
number, so documents of equal m form a stratum, and inside it a term's impact is a
function of tf alone.

Building: a first pass counts the terms of each document, which fixes every m. In a
second one documents become their distinct terms with tf and are dealt by m, a large
stratum by a hash of doc_id too, and each task inverts what it holds: a row of the
index is a part of one stratum, with its documents and, for each term, postings
ordered by tf. The index holds every term of every document and does not depend on
any query.

Searching: a block of items is sent to all tasks. For a part of a stratum the
impact of each run of equal tf is computed once. The impact of a term's largest tf
bounds it in that part, the weighted sum of an item's bounds orders the parts, and
an item leaves them as soon as the next bound is below its k-th best score. Each
task returns at most k documents per item. Equal scores are never cut off, so the
result is exact.

Terms are 64-bit hashes; at 10^9 distinct terms some pair shares one with a chance
of a few percent.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import cut, read, ship
from periodica.llm.word_hashes import word_counts, word_hashes
from periodica.session import read_lines, unique_path, write_lines

# terms are runs of ASCII letters, digits and everything outside ASCII
BETWEEN = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
LAST = 2 ** 63 - 1      # stands for a null doc_id, which ranks last among equals
ROW = "m long, docs binary, terms binary, starts binary, tfs binary, places binary"


@dataclass(frozen=True)
class SearchRules:
    k: int = 10
    texts: int = 256            # hashed together
    part_docs: int = 1024       # of a row of the index, at most 2 ** 16
    part_postings: int = 65536  # of a row, unless one document has more
    items: int = 256            # of a block, about
    slice_postings: int = 262144    # inverted together, unless one document has more
    spread: int = 4096          # documents of a stratum that are kept together; larger ones are dealt out
    group_rows: int = 128       # of the index, searched together
    group_docs: int = 8192


@dataclass(frozen=True)
class LexicalIndex:
    path: str
    n_docs: int     # with a term
    n_terms: int    # with repeats


def _packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary array of consecutive slices of ``values``."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                                  pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _unpacked(col: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and how many each row has."""
    col = col.cast(pa.large_binary())
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), np.diff(at) // np.dtype(kind).itemsize


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _lengths(docs: DataFrame, rules: SearchRules) -> DataFrame:
    """n, docs: how many documents (doc, text) have n terms, by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for whole in batches:
            for a in range(0, whole.num_rows, rules.texts):
                seen.update(word_counts(whole.column(1).slice(a, rules.texts), BETWEEN).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                         names=["n", "docs"])
    return docs.mapInArrow(run, "n long, docs long")


def _terms(docs: DataFrame, rules: SearchRules) -> DataFrame:
    """doc, n, terms, tfs: each document's distinct terms, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, rules.texts):
                b = whole.slice(a, rules.texts)
                h, doc, n = word_hashes(b.column(1), BETWEEN)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = _runs(h, doc)
                tf = np.diff(np.append(first, len(h))).astype(np.uint32)
                per = np.bincount(doc[first], minlength=b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), _packed(h[first], per), _packed(tf, per)],
                                                 names=["doc", "n", "terms", "tfs"])
    return docs.mapInArrow(run, "doc long, n long, terms binary, tfs binary")


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where the rows of sorted ``keys`` differ from the row before."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _parts(m: np.ndarray, postings: np.ndarray, rules: SearchRules) -> list[int]:
    """Where a row of the index begins: at another m, or when a part is full."""
    out, docs, held = [], 0, 0
    for i in range(len(m)):
        if not i or m[i] != m[i - 1] or docs == rules.part_docs or held + postings[i] > rules.part_postings:
            out.append(i)
            docs = held = 0
        docs, held = docs + 1, held + postings[i]
    return out


def _invert(b: pa.RecordBatch, begin: np.ndarray) -> pa.RecordBatch:
    """Rows of the index that begin at these documents (doc, m, terms, tfs)."""
    doc, m = b.column(0).to_numpy(), b.column(1).to_numpy()
    terms, per = _unpacked(b.column(2), np.uint64)
    tfs, _ = _unpacked(b.column(3), np.uint32)
    docs = np.diff(np.append(begin, len(m)))
    of_doc = np.repeat(np.arange(len(m), dtype=np.int32), per)
    owner = np.repeat(np.arange(len(begin), dtype=np.int32), docs)[of_doc]
    order = np.lexsort((tfs, terms, owner))         # postings by part, term and tf
    terms, tfs, owner, of_doc = terms[order], tfs[order], owner[order], of_doc[order]
    new = _runs(terms, owner)
    base = np.searchsorted(owner, np.arange(len(begin)))
    per_part, held = np.bincount(owner[new], minlength=len(begin)), np.bincount(owner, minlength=len(begin))
    return pa.RecordBatch.from_arrays(
        [pa.array(m[begin]), _packed(doc, docs), _packed(terms[new], per_part),
         _packed((new - base[owner[new]]).astype(np.uint32), per_part), _packed(tfs, held),
         _packed((of_doc - begin[owner]).astype(np.uint16), held)],
        names=["m", "docs", "terms", "starts", "tfs", "places"])


def _inverted(rows: DataFrame, rules: SearchRules) -> DataFrame:
    """Rows of the index from documents (doc, m, terms, tfs) that come in order of m."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.column(1).to_numpy()
            per = np.array([len(x) // 8 for x in b.column(2).to_pylist()], np.int64)
            begin = _parts(m, per, rules)
            a = 0
            while a < len(begin):       # a slice of whole parts
                z, held = a, 0
                while z < len(begin) and (z == a or held < rules.slice_postings):
                    end = begin[z + 1] if z + 1 < len(begin) else len(m)
                    held, z = held + int(per[begin[z]:end].sum()), z + 1
                first, last = begin[a], begin[z] if z < len(begin) else len(m)
                yield _invert(b.slice(first, last - first), np.array(begin[a:z]) - first)
                a = z
    return rows.mapInArrow(run, ROW)


def build_index(docs: DataFrame, path: str | None = None, rules: SearchRules = SearchRules(),
                doc_id: str = "doc_id", text: str = "text") -> LexicalIndex:
    """Write the index of all documents to ``path``. A null or text without terms is in no
    stratum; repeated rows are documents of their own; a null doc_id is kept; whole texts
    are read; further columns are ignored."""
    spark = docs.sparkSession
    ship(spark)
    path = path or unique_path(spark, "lexical-index")
    slim = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), F.col(text).alias("text"))
    lengths = cut(_lengths(slim, rules).filter("n > 0").groupBy("n").agg(F.sum("docs").alias("docs")))
    n_docs, n_terms = lengths.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("docs")), F.lit(0))).first()
    m = F.expr(f"100L - 90L + (90L * n * {n_docs}L) div {max(n_terms, 1)}L")
    # large strata are dealt out; there are at most n_docs / spread of them
    large = (lengths.groupBy(m.alias("m")).agg(F.ceil(F.sum("docs") / rules.spread).alias("parts")).filter("parts > 1"))
    rows = _terms(slim, rules).filter("n > 0").select("doc", m.alias("m"), "terms", "tfs").join(F.broadcast(large), "m", "left")
    part = F.pmod(F.xxhash64("doc", "terms"), F.coalesce("parts", F.lit(1)))
    dealt = rows.repartition("m", part).sortWithinPartitions("m").select("doc", "m", "terms", "tfs")
    _inverted(dealt, rules).write.parquet(path)
    write_lines(spark, path + "/_counts", [str(n_docs), str(n_terms)])
    return LexicalIndex(path, n_docs, n_terms)


def open_index(spark: SparkSession, path: str) -> LexicalIndex:
    return LexicalIndex(path, *map(int, read_lines(spark, path + "/_counts")))


def _rows(spark: SparkSession, index: LexicalIndex) -> DataFrame:
    return spark.read.schema(ROW).parquet(index.path)


def _doc_counts(spark: SparkSession, index: LexicalIndex, wanted: np.ndarray) -> np.ndarray:
    """df of each wanted term (sorted hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            terms, per = _unpacked(b.column(0), np.uint64)
            starts, _ = _unpacked(b.column(1), np.uint32)
            ends = np.append(starts[1:], 0).astype(np.int64)
            ends[np.cumsum(per) - 1] = b.column(2).to_numpy()
            at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
            hit = wanted[at] == terms
            np.add.at(df, at[hit], (ends - starts)[hit])
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])
    found = np.zeros(len(wanted), np.int64)
    if len(wanted):
        rows = _rows(spark, index).select("terms", "starts", (F.octet_length("tfs") / 4).cast("long").alias("held"))
        for r in rows.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            found[r["term"]] = r["df"]
    return found


class Items:
    """A block of items: their terms as numbers of a sorted table, with weights."""

    def __init__(self, texts: list[str | None]):
        h, item, _ = word_hashes(pa.array(texts, pa.string()), BETWEEN)
        self.table = np.unique(h)
        at = np.searchsorted(self.table, h)
        self.terms = [np.unique(at[item == i]) for i in range(len(texts))]
        self.weights = np.zeros(len(self.table))

    def weigh(self, n_docs: int, df: np.ndarray) -> None:
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.float64)


class Best:
    """The k best (score, doc) of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """A score that a further document must reach."""
        return self.score[-1] if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        some = np.flatnonzero(score >= self.least)
        if len(some):
            score, doc = np.append(self.score, score[some]), np.append(self.doc, doc[some])
            order = np.lexsort((doc, -score))[:self.k]
            self.score, self.doc = score[order], doc[order]


class Group:
    """Rows of the index, searched together. Scores are whole numbers below 2 ** 53."""

    def __init__(self, b: pa.RecordBatch, items: Items):
        m = b.column(0).to_numpy()
        self.docs, n_docs = _unpacked(b.column(1), np.int64)
        terms, per = _unpacked(b.column(2), np.uint64)
        starts, _ = _unpacked(b.column(3), np.uint32)
        tfs, held = _unpacked(b.column(4), np.uint32)
        places, _ = _unpacked(b.column(5), np.uint16)
        row = np.repeat(np.arange(len(m)), per)
        begin = starts + (np.cumsum(held) - held)[row]
        length = np.diff(np.append(begin, len(tfs)))
        at = np.minimum(np.searchsorted(items.table, terms), max(len(items.table) - 1, 0))
        hit = np.flatnonzero(items.table[at] == terms) if len(items.table) else np.zeros(0, np.int64)
        row, at, length = row[hit], at[hit], length[hit]
        take = _ranges(begin[hit], length)
        of = np.repeat(np.arange(len(hit)), length)
        tf = tfs[take].astype(np.int64)
        # one impact for each run of equal tf
        new = _runs(tf, of)
        once = impact(tf[new], m[row[of[new]]])
        self.impact = np.repeat(once, np.diff(np.append(new, len(tf)))).astype(np.float64)
        self.place = places[take] + (np.cumsum(n_docs) - n_docs)[row[of]]
        shape = (len(m), len(items.table))
        self.start, self.length, self.bound = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape)
        ends = np.cumsum(length)
        self.start[row, at], self.length[row, at] = ends - length, length
        self.bound[row, at] = self.impact[ends - 1]      # that of the largest tf

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Visit the rows by falling bound, a few at first, until none can add to ``best``."""
        bound = self.bound[:, terms] @ weights
        order, a, step = np.argsort(-bound, kind="stable"), 0, 4
        while a < len(order) and bound[order[a]] >= best.least:
            rows = order[a:a + step]
            rows = rows[bound[rows] >= best.least]
            a, step = a + step, 2 * step
            pick = np.ix_(rows, terms)
            lengths = self.length[pick].ravel()
            at = _ranges(self.start[pick].ravel(), lengths)
            score = np.bincount(self.place[at], self.impact[at] * np.repeat(np.tile(weights, len(rows)), lengths), len(self.docs))
            best.add(score, self.docs)


def _found(spark: SparkSession, index: LexicalIndex, items: Items, rules: SearchRules) -> DataFrame:
    """number, doc, score: the best documents of each task for each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(rules.k) for _ in items.terms]
        for b in batches:
            sizes = np.cumsum([len(x) // 8 for x in b.column(1).to_pylist()])
            a = 0
            while a < b.num_rows:
                done = sizes[a - 1] if a else 0
                z = max(a + 1, min(a + rules.group_rows, int(np.searchsorted(sizes, done + rules.group_docs, "right"))))
                group = Group(b.slice(a, z - a), items)
                for terms, top in zip(items.terms, best):
                    if len(terms):
                        group.search(terms, items.weights[terms], top)
                a = z
        for i, top in enumerate(best):
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(top.doc), pa.int64()), pa.array(top.doc, pa.int64()),
                                              pa.array(top.score.astype(np.int64))], names=["number", "doc", "score"])
    return _rows(spark, index).mapInArrow(run, "number long, doc long, score long")


def search(index: LexicalIndex, items: DataFrame, rules: SearchRules = SearchRules(), item_id: str = "item_id",
           text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item.

    Items are taken in blocks of bounded size, each searched in one pass over the
    index. Repeated items are answered one by one; an item without terms, or null,
    finds nothing; an empty index or no items give no rows.
    """
    spark = items.sparkSession
    ship(spark)
    rows = cut(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).withColumn("_i", F.monotonically_increasing_id()))
    blocks = -(-rows.count() // rules.items)
    kind = rows.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for k in range(blocks):
        block = rows.filter(F.pmod(F.xxhash64("_i"), F.lit(blocks)) == k).select("item_id", "text").collect()
        asked = Items([r["text"] for r in block])
        asked.weigh(index.n_docs, _doc_counts(spark, index, asked.table))
        best = Window.partitionBy("number").orderBy(F.desc("score"), "doc")
        found = _found(spark, index, asked, rules).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= rules.k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"number long, item_id {kind}")
        out = out.unionByName(found.join(F.broadcast(names), "number").select(
            "item_id", "rank", F.when(F.col("doc") < LAST, F.col("doc")).alias("doc_id"), "score"))
    return out


def op11_strata_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item, over an index of all documents."""
    return search(build_index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents),
stats AS (SELECT count(*) AS nn, CAST(sum(len(l)) AS BIGINT) AS ll FROM docs WHERE len(l) > 0),
tfs AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(l) AS n, unnest(l) AS term FROM docs) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w FROM dfs, stats),
scores AS (
  SELECT a.item_id, t.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + (90 * t.n * s.nn) // s.ll)))) AS BIGINT) AS score
  FROM asked a JOIN weights w ON w.term = a.term JOIN tfs t ON t.term = a.term, stats s GROUP BY a.item_id, t.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""

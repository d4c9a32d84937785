"""Operator 12: line dedup over levelled sorted runs (DataFrame functions only).

A line's key is the line without white space at both ends, A-Z in lower case; its
two 64-bit hashes stand for it. The keys seen so far are kept in runs: tables
bucketed and sorted by key, each key with its owner, the first document that held
it. A new batch of lines is reduced to one row per key, which needs one shuffle,
and that table is merge-joined with every run, bucket by bucket and without
another shuffle: a key that a run holds keeps its owner, one that none holds gets
the batch's smallest document. The new keys become a run of level 0. As soon as a
level has ``fanout`` runs they are merged into one run of the next, so a batch
meets few runs however many batches came before.

Of a key of at least ``least`` code points, every document but its owner loses its
lines. Batches that follow each other in the order of doc_id make the smallest
doc_id the owner. A batch that is added again after a failure finds its own keys
and gives the same answer.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import SPACES, cut, let, put_back, read, set_aside
from periodica.session import delete_path, list_path, path_exists, unique_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["k1", "k2"]
LAST = 2 ** 63 - 1      # stands for a null doc_id, which ranks last


@dataclass(frozen=True)
class RunRules:
    least: int = 10     # code points of a key that may be dropped
    fanout: int = 2     # runs of a level that are merged into one of the next
    batches: int = 4    # that ``clean_lines`` deals the documents into


@contextmanager
def _sorted_buckets(spark: SparkSession):
    """Scans of runs, which have one file for each bucket, count as sorted: no sort before the merge."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LineRuns:
    """Runs of line keys (k1, k2, owner) in the folder ``root``, which may hold earlier ones.

    A run is a folder ``level-buckets-id``, complete once its writer has marked it,
    and a table of the session's catalog while it is open. A run that was merged
    but not yet removed when a job broke off does no harm: its keys have the same owners.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, rules: RunRules = RunRules()):
        self.spark, self.rules = spark, rules
        self.root = root or unique_path(spark, "line-runs")
        self.runs: list[tuple[int, str, str]] = []      # level, table, folder
        for path in sorted(list_path(spark, self.root)):
            level, buckets, _ = path.rsplit("/", 1)[1].split("-")
            if path_exists(spark, f"{path}/_SUCCESS"):
                table = f"line_run_{uuid.uuid4().hex}"
                spark.sql(f"CREATE TABLE {table} (k1 BIGINT, k2 BIGINT, owner BIGINT) USING parquet "
                          f"CLUSTERED BY (k1, k2) SORTED BY (k1, k2) INTO {buckets} BUCKETS LOCATION '{path}'")
                self.runs.append((int(level), table, path))

    def _write(self, level: int, keys: DataFrame) -> None:
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        tag = uuid.uuid4().hex
        table, path = f"line_run_{tag}", f"{self.root}/{level}-{buckets}-{tag}"
        (keys.select(*KEY, "owner").write.bucketBy(buckets, *KEY).sortBy(*KEY)
         .option("path", path).saveAsTable(table))
        self.runs.append((level, table, path))

    def _merge(self) -> None:
        """Merge the runs of each level that has ``fanout`` of them."""
        level = 0
        while any(r[0] >= level for r in self.runs):
            full = [r for r in self.runs if r[0] == level]
            if len(full) >= self.rules.fanout:
                rows = self.spark.table(full[0][1])
                for _, table, _ in full[1:]:
                    rows = rows.unionByName(self.spark.table(table))
                self._write(level + 1, rows.groupBy(*KEY).agg(F.min("owner").alias("owner")))
                self._drop(full)
            level += 1

    def _drop(self, runs: list[tuple[int, str, str]]) -> None:
        for r in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {r[1]}")
            delete_path(self.spark, r[2])
            self.runs.remove(r)

    def add(self, lines: DataFrame) -> DataFrame:
        """Add the keys of a batch (k1, k2, doc) and return those that some document of
        the batch holds without owning them: (k1, k2, owner)."""
        keys = lines.groupBy(*KEY).agg(F.min("doc").alias("_low"), F.max("doc").alias("_high"))
        held = []
        for i, (_, table, _) in enumerate(self.runs):
            run = self.spark.table(table).withColumnRenamed("owner", f"_o{i}").hint("merge")
            keys, held = keys.join(run, KEY, "left"), [*held, F.col(f"_o{i}")]
        before = F.least(*held, F.lit(None)) if held else F.lit(None).cast("long")
        with _sorted_buckets(self.spark):
            keys = cut(keys.select(*KEY, before.alias("_before"), "_low", "_high"))
        self._write(0, keys.filter("_before IS NULL").withColumn("owner", F.col("_low")))
        self._merge()
        owner = F.coalesce("_before", "_low")
        return keys.select(*KEY, owner.alias("owner"), "_low", "_high").filter(
            "_low <> owner OR _high <> owner").select(*KEY, "owner")

    def close(self, keep: bool = True) -> None:
        """Forget the tables, and remove the folders too unless they are kept for later batches."""
        for _, table, _ in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.runs = []
        if not keep:
            delete_path(self.spark, self.root)


def _key(line: Column) -> Column:
    """Lower case for A-Z only; in a line of ASCII alone that is what ``lower`` does, faster."""
    bare = F.trim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, UPPER.lower()))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, rules: RunRules, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, body (a hash of the text), place, k1, k2: the lines whose key is long enough."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"),
                       F.posexplode(_lines(F.col(text))).alias("place", "line"))
    rows = rows.select("doc", "body", "place", _key(F.col("line")).alias("key"))
    return rows.filter(F.length("key") >= rules.least).select(
        "doc", "body", "place", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("line"), "key").alias("k2"))


def clean_lines(docs: DataFrame, rules: RunRules = RunRules(), doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the lines left in ``text``, and n_lines and n_dropped.

    Documents are dealt into batches by doc_id, in ascending order. A null text
    counts as empty, one empty line; rows of one doc_id are one document; a null
    doc_id ranks last; equal rows lose the same lines; a text that loses all its
    lines becomes empty; whole texts are read, whatever their length; an empty
    table gives no rows; further columns stay as they are.
    """
    spark = docs.sparkSession
    place = unique_path(spark, "lines")
    shares = [i / rules.batches for i in range(1, rules.batches)]
    limits = docs.agg(F.percentile_approx(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)), shares)).first()[0] if shares else None
    limits = sorted(set(limits or []))
    batch = F.lit(0)
    for limit in limits:
        batch = batch + (F.col("doc") > limit).cast("int")
    keyed_lines(docs, rules, doc_id, text).withColumn("batch", batch).write.partitionBy("batch").parquet(place)
    lines = spark.read.schema("doc long, body long, place int, k1 long, k2 long, batch int").parquet(place)
    runs, dropped = LineRuns(spark, rules=rules), None
    for b in range(len(limits) + 1):
        mine = lines.filter(F.col("batch") == b).drop("batch")
        gone = mine.join(runs.add(mine), KEY).filter("doc <> owner").select("doc", "body", "place")
        dropped = gone if dropped is None else dropped.unionByName(gone)
    runs.close(keep=False)
    # positions of a document's dropped lines; equal rows name each of them more than once
    places = cut(dropped.groupBy("doc", "body").agg(F.sort_array(F.collect_set("place")).alias("places")))
    delete_path(spark, place)
    keep = [doc_id, text]
    rows = set_aside(docs, keep).withColumns({
        "_doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)),
        "_body": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    rows = rows.join(places.hint("shuffle_hash"), (F.col("_doc") == F.col("doc")) & (F.col("_body") == F.col("body")), "left")
    all_lines = _lines(F.col(text))
    # what is left lies between the dropped places: one slice for each gap
    starts = F.concat(F.array(F.lit(0)), F.transform("places", lambda p: p + 1))
    left = let(all_lines, lambda x: F.array_join(F.flatten(F.zip_with(
        starts, F.concat(F.col("places"), F.array(F.size(x))), lambda a, b: F.slice(x, a + 1, b - a))), "\n"))
    out = rows.select("*", F.size(all_lines).cast("long").alias("_n"),
                      F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("_gone"))
    out = out.withColumn(text, F.when(F.col("places").isNull(), F.col(text)).otherwise(left))
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return put_back(out.drop("doc", "body", "places"), cols, keep, F.col("_n").alias("n_lines"), F.col("_gone").alias("n_dropped"))


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that a document of smaller doc_id holds."""
    left = clean_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.place, u.line, lower_az.key
  FROM documents, LATERAL (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place) u,
       LATERAL (SELECT translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key) lower_az),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT l.*, (o.owner IS NOT NULL AND o.owner <> l.doc_id) AS gone FROM lines l LEFT JOIN owners o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

"""Operator 13: conversation prefix trie by fixed-length block hashing.

Conversations are sequences of turns (role, text). Every distinct sequence of
first turns is a node of the trie. A turn enters with two 64-bit hashes salted by
its place, and a prefix is the xor of its turns' hashes, so prefixes of blocks and
of turns come from the same numbers:

1. turns are xored into blocks of ``block`` turns, blocks are xored along each
   conversation, and conversations are grouped by the prefix before a block;
2. where all of a group hold the same block, its turns are read from one of them,
   the smallest conv_id, for all; only where siblings diverge, or some end inside
   the block, every member's turns are walked to find the boundary;
3. sums over subtrees need no walk down the trie: a node's subtree is what its
   members hold from it on. Each node counts for one member, the smallest, so
   what a member adds to any subtree above is one number per conversation, and a
   subtree's sum is a sum over the members of one node.

All groups are counted by aggregations that combine before the shuffle. Nodes with
more than a thousandth of all rows, of which there are less than a thousand, are
joined by broadcast, all others by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import cut, read, ship

BEFORE = (Window.unboundedPreceding, -1)
NONE_SHA = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieRules:
    block: int = 4          # turns
    span: int = 256         # blocks that are summed up by themselves
    heavy: int = 1000       # a group of over 1 / heavy of the rows is joined by broadcast
    chunk: int = 512        # ids joined into one string


def numbered(rows: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: the place of a row in its group, from 0, in the order of ``order``.

    Rows are sorted by ranges of group and order together, so a group of any size is
    spread over partitions; a row's place is that in its partition plus what the
    partitions before hold of its group."""
    rows = cut(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order))
    rows = rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_i"))
    parts = rows.groupBy(group, "_part").agg(F.min("_i").alias("_lo"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(*BEFORE)
    parts = parts.select(group, "_part", "_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (rows.join(parts, [group, "_part"]).withColumn(out, F.col("_base") + F.col("_i") - F.col("_lo"))
            .drop("_part", "_i", "_lo", "_base"))


def turns_of(convs: DataFrame) -> DataFrame:
    """conv, at, t1, t2 (hashes of role and text), bytes (of the text): the turns in order.

    Ordered by turn, null first, then by hash; a null role or text is empty; rows without
    conv_id belong to no conversation; repeated rows are turns of their own."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = convs.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit("turn"), role, text).alias("t2"), F.octet_length(text).cast("long").alias("bytes"))
    return numbered(rows, "conv", ["turn", "t1", "t2"], "at").drop("turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv), and the turns of each: the first h of conversation
    conv - conv % 5, h = crc32(conv) % 9, then its own after its first h."""
    ids = turns.groupBy("conv").agg(F.count("*").alias("n"))
    plan = ids.select("conv", (F.col("conv") - F.col("conv") % 5).alias("base"),
                      (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).alias("h"))
    sizes = ids.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = cut(plan.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))))
    first = (turns.filter("at < 8").withColumnRenamed("conv", "base").join(plan, "base").filter("at < h")
             .select("conv", "at", "t1", "t2", "bytes"))
    own = (turns.join(plan, "conv").filter("at >= h")
           .select("conv", (F.col("taken") + F.col("at") - F.col("h")).alias("at"), "t1", "t2", "bytes"))
    return plan.select("conv"), first.unionByName(own)


def _grouped(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, rules: TrieRules) -> DataFrame:
    """Join rows to the group they are in, where a group may hold any share of the rows."""
    large = F.broadcast(groups.filter(F.col(size) * rules.heavy > total))
    small = groups.filter(F.col(size) * rules.heavy <= total)
    return rows.join(large, keys).unionByName(
        rows.join(large.select(*keys), keys, "left_anti").join(small, keys))


def _blocks(turns: DataFrame, rules: TrieRules) -> DataFrame:
    """conv, b, q1, q2, above: each block with the prefix before it; e1, e2: with it."""
    each = (turns.groupBy("conv", "b").agg(F.bit_xor("p1").alias("d1"), F.bit_xor("p2").alias("d2"), F.sum("bytes").alias("bytes"))
            .withColumn("span", F.floor(F.col("b") / rules.span)))

    def running(d: DataFrame, w, x: str) -> list:
        return [F.coalesce(F.bit_xor("d1").over(w), F.lit(0)).alias(f"{x}1"), F.coalesce(F.bit_xor("d2").over(w), F.lit(0)).alias(f"{x}2"),
                F.coalesce(F.sum("bytes").over(w), F.lit(0)).alias(f"{x}b")]
    spans = each.groupBy("conv", "span").agg(F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"), F.sum("bytes").alias("bytes"))
    spans = spans.select("conv", "span", *running(spans, Window.partitionBy("conv").orderBy("span").rowsBetween(*BEFORE), "s"))
    inside = each.select("*", *running(each, Window.partitionBy("conv", "span").orderBy("b").rowsBetween(*BEFORE), "i"))
    q1, q2 = F.col("s1").bitwiseXOR(F.col("i1")), F.col("s2").bitwiseXOR(F.col("i2"))
    return inside.join(spans, ["conv", "span"]).select(
        "conv", "b", q1.alias("q1"), q2.alias("q2"), (F.col("sb") + F.col("ib")).alias("above"),
        q1.bitwiseXOR(F.col("d1")).alias("e1"), q2.bitwiseXOR(F.col("d2")).alias("e2"))


GROUP, NODE = ["q1", "q2", "b"], ["f1", "f2", "depth"]


def ends_digest(ends: DataFrame, rules: TrieRules) -> DataFrame:
    """f1, f2, ends_sha256: of the conv numbers of each (f1, f2), ascending, joined by commas.

    A digest of one long string is made in sequence, whatever holds it. Numbers are
    sorted and joined into strings in many tasks; the task of a node reads these
    strings one after the other and holds no more than the digest's state."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, d = {"f1": [], "f2": [], "low": [], "ids": []}, b.to_pydict()
            last = None
            for f1, f2, c in zip(d["f1"], d["f2"], d["conv"]):
                if (f1, f2) != last or len(out["ids"][-1]) == rules.chunk:
                    for k, v in zip(out, (f1, f2, c, [])):
                        out[k].append(v)
                    last = (f1, f2)
                out["ids"][-1].append(str(c))
            out["ids"] = [",".join(x) for x in out["ids"]]
            yield pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.int64()) for k in ("f1", "f2", "low")] + [("ids", pa.string())]))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for b in batches:
            out, d = {"f1": [], "f2": [], "ends_sha256": []}, b.to_pydict()
            for f1, f2, ids in zip(d["f1"], d["f2"], d["ids"]):
                if (f1, f2) != at:
                    if at is not None:
                        for k, v in zip(out, (*at, state.hexdigest())):
                            out[k].append(v)
                    at, state = (f1, f2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict(out, pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("ends_sha256", pa.string())]))
        if at is not None:
            yield pa.RecordBatch.from_pydict({"f1": [at[0]], "f2": [at[1]], "ends_sha256": [state.hexdigest()]})
    key = ["f1", "f2", "conv"]
    parts = (ends.repartitionByRange(*key).sortWithinPartitions(*key)
             .mapInArrow(joined, "f1 long, f2 long, low long, ids string"))
    return (parts.repartition("f1", "f2").sortWithinPartitions("f1", "f2", "low").select("f1", "f2", "ids")
            .mapInArrow(digest, "f1 long, f2 long, ends_sha256 string"))


def trie_nodes(ids: DataFrame, turns: DataFrame, rules: TrieRules = TrieRules()) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256: one row per node of the conversations ``ids`` (conv) with ``turns``
    (conv, at, t1, t2, bytes); no conversations, no rows."""
    salted = [F.xxhash64(F.lit(i), "at", "t1", "t2").alias(f"p{i}") for i in (1, 2)]
    turns = cut(turns.select("conv", "at", F.floor(F.col("at") / rules.block).alias("b"), "bytes", *salted))
    blocks = cut(_blocks(turns, rules))
    total = blocks.count()
    groups = cut(blocks.groupBy(*GROUP).agg(
        F.count("*").alias("n"), F.min("conv").alias("low"),
        ((F.min("e1") == F.max("e1")) & (F.min("e2") == F.max("e2"))).alias("same")))

    # turns to walk: of every member where siblings diverge, of one where they agree
    placed = cut(_grouped(blocks.select("conv", *GROUP, "above"), groups.select(*GROUP, "n", "low", "same"), GROUP, "n", total, rules))
    walk = placed.filter("NOT same OR conv = low").select(
        "conv", *GROUP, "above", F.when(F.col("same"), F.col("n")).otherwise(1).alias("weight"))
    inside = Window.partitionBy("conv", "b").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    path = walk.join(turns, ["conv", "b"]).select(
        "conv", "b", (F.col("at") + 1).alias("depth"), "bytes", "weight",
        F.col("q1").bitwiseXOR(F.bit_xor("p1").over(upto)).alias("f1"),
        F.col("q2").bitwiseXOR(F.bit_xor("p2").over(upto)).alias("f2"), "p1", "p2",
        (F.col("above") + F.sum("bytes").over(upto) - F.col("bytes")).alias("above"))
    path = cut(path.select("*", F.col("f1").bitwiseXOR(F.col("p1")).alias("g1"), F.col("f2").bitwiseXOR(F.col("p2")).alias("g2")).drop("p1", "p2"))
    nodes = path.groupBy(*NODE).agg(
        F.sum("weight").alias("n"), F.min("conv").alias("conv_id"), F.min("g1").alias("g1"), F.min("g2").alias("g2"),
        F.min("bytes").alias("bytes"), F.min("above").alias("above"))
    zero, no = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = (ids.agg(F.count("*").alias("n"), F.min("conv").alias("conv_id")).filter("n > 0")
            .select(zero.alias("f1"), zero.alias("f2"), zero.alias("depth"), "n", "conv_id", no.alias("g1"), no.alias("g2"),
                    zero.alias("bytes"), zero.alias("above")))
    nodes = nodes.unionByName(root)
    children = nodes.filter("depth > 0").groupBy(F.col("g1").alias("f1"), F.col("g2").alias("f2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    nodes = cut(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)))

    # what each conversation adds to the subtrees it is in
    own = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum("bytes").alias("own"), F.min("above").alias("above_own"),
        F.count_if(F.col("n_children") == 0).alias("leaf"))
    whole = turns.groupBy("conv").agg(F.sum("bytes").alias("whole"), F.bit_xor("p1").alias("f1"), F.bit_xor("p2").alias("f2"))
    each = cut(ids.join(own, "conv", "left").join(whole, "conv", "left").select(
        "conv", "above_own", *[F.coalesce(c, zero).alias(c) for c in ("own", "leaf", "whole", "f1", "f2")]))
    adds = ["own", "leaf", "whole"]
    sums = [F.sum(c).alias(c) for c in adds]
    member = placed.join(each.select("conv", *adds), "conv")
    agreed = member.filter("same").groupBy(F.col("low").alias("conv"), "b").agg(*sums)
    apart = member.filter("NOT same").select("conv", "b", *adds)
    below = (path.select("conv", "b", *NODE).join(apart.unionByName(agreed), ["conv", "b"]).groupBy(*NODE).agg(*sums)
             .unionByName(each.agg(*sums).select(zero.alias("f1"), zero.alias("f2"), zero.alias("depth"), *adds)))
    # each of these has one row for a node at most
    first = each.select(F.col("conv").alias("conv_id"), "above_own")
    out = nodes.join(below, NODE).join(first, "conv_id").join(ends_digest(each.select("f1", "f2", "conv"), rules), ["f1", "f2"], "left")
    parents = nodes.filter("n_children > 0").select(
        F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("k"))
    found = _grouped(nodes.filter("depth > 0").select(*NODE, "g1", "g2"), parents, ["g1", "g2"], "k", nodes.count(), rules)
    out = out.join(found.select(*NODE, "parent_conv_id"), NODE, "left")
    saved = F.col("whole") - F.col("n") * F.col("above") - F.col("own") + F.col("above") - F.col("above_own")
    return out.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaf").alias("n_leaves"),
                      saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NONE_SHA)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of another."""
    ship(spark)
    turns = cut(turns_of(read(spark, sf_dir, "conversations")))
    return trie_nodes(*rebuilt(turns))


OP13_SQL = """
WITH RECURSIVE ordered AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS at
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT conv_id, list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
         lambda a, x: list_reduce([xor(a, x)] || [0, 0, 0, 0, 0, 0, 0, 0],
                        lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS state
  FROM (SELECT DISTINCT conv_id FROM ordered)),
plan AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(state, 4294967295) % 9 AS h FROM crc),
turns AS (
  SELECT p.conv_id, 0 AS part, o.at, o.role, o.text FROM plan p JOIN ordered o ON o.conv_id = p.base AND o.at < p.h
  UNION ALL SELECT p.conv_id, 1, o.at, o.role, o.text FROM plan p JOIN ordered o ON o.conv_id = p.conv_id AND o.at >= p.h),
lists AS (
  SELECT p.conv_id, coalesce(list({'role': t.role, 'text': t.text} ORDER BY t.part, t.at) FILTER (WHERE t.at IS NOT NULL), []) AS l
  FROM plan p LEFT JOIN turns t ON t.conv_id = p.conv_id GROUP BY p.conv_id),
prefixes AS (SELECT conv_id, l, d, list_slice(l, 1, d) AS p FROM (SELECT conv_id, l, unnest(range(len(l) + 1)) AS d FROM lists)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n,
         coalesce(string_agg(CASE WHEN len(l) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends,
         CASE WHEN d > 0 THEN list_slice(p, 1, d - 1) END AS up, CASE WHEN d > 0 THEN strlen(p[d].text) ELSE 0 END AS bytes
  FROM prefixes GROUP BY p, d),
kids AS (SELECT up, count(*) AS k FROM nodes WHERE up IS NOT NULL GROUP BY up),
full_nodes AS (SELECT n.*, coalesce(k.k, 0) AS k FROM nodes n LEFT JOIN kids k ON k.up = n.p),
above AS (SELECT list_slice(p, 1, a) AS p, n, k, bytes FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_nodes)),
below AS (SELECT p, count(*) FILTER (WHERE k = 0) AS leaves, sum((n - 1) * bytes) AS saved FROM above GROUP BY p)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.k AS n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN below b ON b.p = f.p LEFT JOIN nodes u ON u.p = f.up"""

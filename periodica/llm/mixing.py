"""Operator 3: mixing sources to target weights (DataFrame functions only).

The words of each source, its documents in hash order, are packed into blocks of
a fixed number of words. The mix is a sequence of output shards of ``slots``
slots. Every slot draws its source, so the source counts of a shard are a
multinomial draw; where the counts of all shards together miss a source's quota
of blocks, the surplus slots go to the sources that fall short. The i-th slot of
a source takes the block at position i of a pseudorandom permutation of the
source's blocks (a new permutation for each pass), and slots meet blocks by an
equi-join on (source, block).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import chunks_for, cut, let, put_back, read, running_start, set_aside, words_of


@dataclass(frozen=True)
class MixRules:
    weights: tuple[int, ...] = (5, 2, 1)  # by rank of the source, repeating
    share: float = 1.5                    # of all words
    most: float = 2.0                     # times a source's own words
    block: int = 64                       # words
    slots: int = 1024                     # blocks of an output shard
    rounds: int = 12                      # of the index permutation
    task_slots: int = 65536               # numbered by one task, about
    cells: int = 4096                     # of the table that a slot draws its source from
    seed: int = 11


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, source, size in words, a hash of the text."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       F.size(words_of(F.col(text))).cast("long").alias("size"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))


def source_targets(rows: DataFrame, rules: MixRules) -> DataFrame:
    """source, source_size, target, n_blocks, quota (blocks to take), lo (start of its quota).

    Sources rank by code point, null last. Targets share the words by weight; a
    source is held at ``most`` times its size and the excess is shared again,
    which is one water level: in order of cap / weight, a source is held when the
    level that fills it needs no more words than there are. The table has one row
    per source; its windows run over sources, never over documents.
    """
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in rules.weights])
    s = s.withColumn("w", F.get(weights, (F.row_number().over(everything) - 1) % len(rules.weights)))
    s = s.withColumn("cap", F.col("source_size") * F.lit(rules.most))
    s = s.withColumn("level", F.col("cap") / F.col("w"))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    up_to, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    s = s.withColumn("words", F.sum("source_size").over(whole) * F.lit(rules.share))
    s = s.withColumn("held", (F.coalesce(F.sum("cap").over(up_to), F.lit(0.0)) + F.col("level")
                              * F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
                     <= F.col("words"))
    rest = F.sum(F.when(F.col("held"), 0.0).otherwise(F.col("w"))).over(whole)
    left = F.col("words") - F.sum(F.when(F.col("held"), F.col("cap")).otherwise(0.0)).over(whole)
    s = s.withColumn("target", F.when(F.col("held"), F.col("cap")).otherwise(left * F.col("w") / rest))
    s = s.withColumn("n_blocks", F.ceil(F.col("source_size") / F.lit(rules.block)).cast("long"))
    mean = F.col("source_size") / F.col("n_blocks")
    s = s.withColumn("quota", F.when(F.col("n_blocks") == 0, 0).otherwise(
        F.least(F.round(F.col("target") / mean), F.col("n_blocks") * F.lit(int(rules.most)))).cast("long"))
    return s.select("source", "source_size", "target", "n_blocks", "quota", F.coalesce(
        F.sum("quota").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("lo"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def permuted(index: Column, n: Column, key: list[Column], rounds: int) -> Column:
    """A pseudorandom permutation of 0..n-1: in each round an index and its partner
    ``k - index mod n`` swap places or not, as a hash of the pair decides."""
    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        coin = F.pmod(F.xxhash64(*key, r, F.greatest(x, partner)), F.lit(2))
        return F.when(coin == 1, partner).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), swap)


def drawn_slots(targets: DataFrame, rules: MixRules) -> DataFrame:
    """shard, source, block, pass: one row for each slot of the mix. ``targets`` is cut."""
    spark = targets.sparkSession
    total = targets.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    cell = max(1.0, total / rules.cells)
    reach = targets.filter("quota > 0").select("source", "lo", (F.col("lo") + F.col("quota")).alias("hi"))
    reach = reach.select("*", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))).alias("cell"))
    u = F.pmod(F.xxhash64(F.lit(rules.seed), F.col("id")), F.lit(total or 1))
    slots = spark.range(total).select(F.floor(F.col("id") / rules.slots).alias("shard"), u.alias("u"),
                                      F.floor(u / cell).alias("cell"))
    counts = (slots.join(reach, "cell").filter("u >= lo AND u < hi")
              .groupBy("shard", "source").agg(F.count("*").alias("n")))
    counts = cut(counts)
    got = counts.groupBy("source").agg(F.sum("n").alias("got")).withColumnRenamed("source", "_s")
    balance = (targets.filter("quota > 0").join(got, _same("source", "_s"), "left")
               .select("source", "quota", "n_blocks", F.coalesce("got", F.lit(0)).alias("got")))
    # surplus and shortfall are laid end to end in source order; where their intervals
    # overlap, that part of one source's surplus slots becomes slots of the other
    order = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    balance = balance.withColumns({"over": F.greatest(F.col("got") - F.col("quota"), F.lit(0)),
                                   "under": F.greatest(F.col("quota") - F.col("got"), F.lit(0))})
    balance = balance.withColumns({"over_at": F.coalesce(F.sum("over").over(order), F.lit(0)),
                                   "under_at": F.coalesce(F.sum("under").over(order), F.lit(0))})
    over = balance.filter("over > 0").select(
        F.col("over_at").alias("at"), F.struct("source", "quota", F.col("over_at").alias("start")).alias("o"),
        F.lit(None).alias("u"))
    under = balance.filter("under > 0").select(
        F.col("under_at").alias("at"), F.lit(None).alias("o"),
        F.struct("source", "got", F.col("under_at").alias("start")).alias("u"))
    at = Window.orderBy("at")
    moves = cut(over.unionByName(under).groupBy("at").agg(F.max("o").alias("o"), F.max("u").alias("u"))
             .select("at", F.last("o", True).over(at).alias("o"), F.last("u", True).over(at).alias("u"),
                     F.lead("at").over(at).alias("to"))
             .select(F.col("o.source").alias("_ms"), F.col("u.source").alias("to_source"),
                     (F.col("o.quota") + F.col("at") - F.col("o.start")).alias("from_i"),
                     (F.col("o.quota") + F.col("to") - F.col("o.start")).alias("to_i"),
                     (F.col("u.got") + F.col("at") - F.col("u.start")).alias("new_i")))
    at_shard = running_start(counts, ["source"], ["shard"], "n", chunks_for(counts.count()), "start")
    # a row of counts stands for many slots: tasks are sized by slots, not by rows
    at_shard = cut(at_shard).repartition(-(-total // rules.task_slots) or 1, "shard", "source")
    each = at_shard.select("shard", "source", F.posexplode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("j", "_"),
                           "start").select("shard", "source", (F.col("start") + F.col("j")).alias("i"))
    moved = each.join(moves, _same("source", "_ms") & (F.col("i") >= F.col("from_i"))
                      & ((F.col("i") < F.col("to_i")) | F.col("to_i").isNull()), "left")
    moved = moved.select("shard", F.when(F.col("from_i").isNull(), F.col("source")).otherwise(F.col("to_source")).alias("source"),
                         F.when(F.col("from_i").isNull(), F.col("i"))
                         .otherwise(F.col("new_i") + F.col("i") - F.col("from_i")).alias("i"))
    known = balance.select(F.col("source").alias("_bs"), "n_blocks")
    out = moved.join(known, _same("source", "_bs"))
    turn = F.floor(F.col("i") / F.col("n_blocks"))
    key = [F.lit(rules.seed), F.col("source"), turn]
    return out.select("shard", "source", turn.alias("pass"), permuted(
        F.col("i") % F.col("n_blocks"), F.col("n_blocks"), key, rules.rounds).alias("block"))


def pieces(placed: DataFrame, rules: MixRules) -> DataFrame:
    """The parts of each document (source, start, size) in each block: from_word, words."""
    b = F.lit(rules.block)
    p = placed.filter("size > 0").select("*", F.explode(F.sequence(
        F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))).alias("block"))
    first = F.greatest(F.col("start"), F.col("block") * b)
    return p.select("*", (first - F.col("start")).alias("from_word"),
                    (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b) - first).alias("words"))


def _times(targets: DataFrame, rules: MixRules) -> DataFrame:
    """How often each block is taken; cut, so that the plans that use it stay small."""
    return cut(drawn_slots(targets, rules).groupBy("source", "block").agg(F.count("*").alias("times"))
               .select(F.col("source").alias("_ts"), F.col("block").alias("_tb"), "times"))


ORDER = ["doc_id", "text_hash", "size"]


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per document.

    A null or empty text has no words and takes none; a null source is a source
    of its own and ranks last; equal rows are separate documents; a null doc_id
    is kept; an empty table gives no rows; further columns are ignored.
    """
    rows = cut(sized(docs))
    placed = running_start(rows, ["source"], ORDER, "size", chunks_for(rows.count()), "start")
    targets = cut(source_targets(rows, rules))
    parts = pieces(placed, rules)
    hit = parts.join(_times(targets, rules), _same("source", "_ts") & (F.col("block") == F.col("_tb")), "left")
    taken = (hit.groupBy("source", "start", "doc_id", "size")
             .agg(F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).alias("taken"))
             .select("doc_id", "source", "size", "taken"))
    none = rows.filter("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    known = targets.select(F.col("source").alias("_s"), "source_size", "target")
    return (taken.unionByName(none).join(known, _same("source", "_s"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mix as documents: for each repeat of a document, the words of its drawn blocks.

    Has the columns of ``docs``, n_chars counted anew; the text of a repeat that took the
    whole document is the document's own, that of another joins its words by spaces.
    """
    slim = cut(sized(docs))
    targets = cut(source_targets(slim, rules))
    keep = ["doc_id", "source", "text", "n_chars"]
    full = set_aside(docs, keep).select("*", F.size(words_of(F.col("text"))).cast("long").alias("size"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    chunks = chunks_for(slim.count())
    placed = running_start(slim, ["source"], ORDER, "size", chunks, "start")
    drawn = pieces(placed, rules).join(_times(targets, rules), _same("source", "_ts") & (F.col("block") == F.col("_tb")))
    part = F.struct("from_word", "words", "times")
    drawn = (drawn.groupBy("source", "start").agg(F.sort_array(F.collect_list(part)).alias("parts"))
             .select(F.col("source").alias("_ds"), F.col("start").alias("_dt"), "parts"))
    texts = running_start(full, ["source"], ORDER, "size", chunks, "start").filter("size > 0")
    out = texts.join(drawn, _same("source", "_ds") & (F.col("start") == F.col("_dt")))
    out = out.withColumn("_r", F.explode(F.sequence(F.lit(1), F.array_max(F.transform("parts", lambda p: p["times"])))))
    out = out.withColumn("parts", F.filter("parts", lambda p: p["times"] >= F.col("_r")))
    words = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    some = let(words_of(F.col("text")), lambda w: F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(
        w, (p["from_word"] + 1).cast("int"), p["words"].cast("int")))), " "))
    out = out.withColumn("text", F.when(words == F.col("size"), F.col("text")).otherwise(some))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(words == F.col("size"), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return put_back(out, docs.columns, keep)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by source to the weights 5, 2, 1."""
    return mix(read(spark, sf_dir, "documents"))

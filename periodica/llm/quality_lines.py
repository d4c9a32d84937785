"""Operator 5: quality rules with cross-document line frequency (DataFrame functions only).

Lines are normalised (lower case, white space collapsed) and hashed. Per host the
number of documents that hold a line is counted, each row being a document. Lines
held by more than the share ``max_share`` of their host's documents, and by more
than ``max_docs`` of them, are removed, except from the line's first holder, the
text of the smallest hash, so no content vanishes altogether; exact copies of that
text are left to a stage that looks for copies. A document left with less than
``min_left`` of its words is depleted and rejected, as are those that fail the base
rules.

Each document's distinct lines are counted with a partial sum in every task, so a
line's count needs neither its documents nor their texts in the shuffle. The few
lines above the limits then find their documents by value.

A null or empty text has no words and fails the base rule; a null host is a host
of its own; equal rows get equal verdicts; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import SPACES, WORD_SPLIT, cut, let, put_back, read, set_aside, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
HAS_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class LineRules:
    max_docs: int = 20          # holders that a line may have on a host of any size
    max_share: float = 0.06     # of the host's documents
    min_left: float = 0.3
    min_words: int = 20
    max_repeat_pct: int = 30
    broadcast_lines: int = 500_000      # lines above the limits, of at most 64 bytes; more are joined by a shuffle


def _repeat_words(hashes: Column) -> Column:
    """Words inside 8-word windows that occur at least twice."""
    def windows(h: Column) -> Column:
        n = F.size(h)
        return F.when(n >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW)))))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            return F.transform(s, lambda x, j: F.when(
                (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))
        at = F.sort_array(F.filter(let(ordered, repeated), lambda p: p.isNotNull()))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(at, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")))["n"]
    return let(let(hashes, windows), lambda w: F.when(
        w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)), F.lit(0)).otherwise(covered(w)))


def _keyed(docs: DataFrame, host: str, text: str) -> DataFrame:
    """host and a 128-bit hash of the text: one key per distinct text of a host."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select("*", F.col(host).alias("_host"), body.alias("_body"),
                       F.xxhash64(body).alias("_k1"), F.xxhash64(F.lit("k"), body).alias("_k2"))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), WORD_SPLIT, " ")))


def base_metrics(docs: DataFrame, rules: LineRules, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select("*", body.alias("_b"), words_of(F.col(text)).alias("_w"))
    lines = F.filter(F.split(F.col("_b"), "\n", -1), lambda x: x.rlike(HAS_WORD))
    d = d.select("*", F.size("_w").cast("long").alias("n_words"),
                 F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"), lines.alias("_l"))
    d = d.select(
        "*", F.length(F.translate("_b", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_b") - F.length(F.translate("_b", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_h")).cast("long").alias("n_repeat_words"))
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")))
    return d.withColumn("base_failed", failed).drop("_b", "_w", "_h", "_l")


def _hashed_lines(text: Column) -> Column:
    """Hashes of the lines that have a word, in order."""
    return F.transform(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD)), _line_hash)


def common_lines(docs: DataFrame, rules: LineRules, host: str = "source", text: str = "text") -> DataFrame:
    """_ch, _cl: the lines (hashes) of each host that are above the limits."""
    body = F.coalesce(F.col(text), F.lit(""))
    sizes = docs.groupBy(F.col(host).alias("_sh")).agg(F.count("*").alias("_size"))
    held = (docs.select(F.col(host).alias("_ch"), F.explode(F.array_distinct(_hashed_lines(body))).alias("_cl"))
            .groupBy("_ch", "_cl").agg(F.count("*").alias("_docs")).filter(F.col("_docs") > rules.max_docs))
    return cut(held.join(sizes, F.col("_ch").eqNullSafe(F.col("_sh")) & (F.col("_docs") > rules.max_share * F.col("_size")))
               .select("_ch", "_cl"))


def removed_lines(docs: DataFrame, rules: LineRules, host: str = "source", text: str = "text") -> DataFrame:
    """One row per distinct text of a host that loses lines: _host, _k1, _k2, hashes of its
    lines to remove, and how many words they have."""
    common = common_lines(docs, rules, host, text)
    if common.count() <= rules.broadcast_lines:
        common = F.broadcast(common)
    k = _keyed(docs.select(F.col(host), F.col(text)), host, text)
    lines = k.select("_host", "_k1", "_k2", F.posexplode(F.split("_body", "\n", -1)).alias("_at", "_line"))
    lines = lines.filter(F.col("_line").rlike(HAS_WORD)).withColumn("_lh", _line_hash(F.col("_line")))
    hit = lines.join(common, F.col("_host").eqNullSafe(F.col("_ch")) & (F.col("_lh") == F.col("_cl")))
    # copies of a text have the same lines at the same places
    hit = hit.groupBy("_host", "_lh", "_k1", "_k2", "_at").agg(F.max(F.size(words_of(F.col("_line")))).alias("_n"))
    hit = hit.groupBy("_host", "_lh", "_k1", "_k2").agg(F.sum("_n").alias("_n"))
    first = (hit.groupBy("_host", "_lh").agg(F.min(F.struct("_k1", "_k2")).alias("_first"))
             .withColumnsRenamed({"_host": "_fh", "_lh": "_fl"}))
    hit = hit.join(first, F.col("_host").eqNullSafe(F.col("_fh")) & (F.col("_lh") == F.col("_fl"))).filter(
        ~((F.col("_first._k1") == F.col("_k1")) & (F.col("_first._k2") == F.col("_k2"))))
    return hit.groupBy("_host", "_k1", "_k2").agg(F.collect_list("_lh").alias("_lines"), F.sum("_n").alias("_gone"))


def _words_left() -> Column:
    return F.coalesce(F.lit(1.0) - F.col("_gone") / F.col("n_words"), F.lit(1.0))


def _with_removed(rows: DataFrame, removed: DataFrame, columns: list[str]) -> DataFrame:
    r = removed.select(F.col("_host").alias("_rh"), F.col("_k1").alias("_r1"), F.col("_k2").alias("_r2"), *columns)
    return rows.join(r, F.col("_host").eqNullSafe(F.col("_rh")) & (F.col("_k1") == F.col("_r1"))
                     & (F.col("_k2") == F.col("_r2")), "left").drop("_rh", "_r1", "_r2")


def quality(docs: DataFrame, rules: LineRules = LineRules(), host: str = "source",
            text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, base metrics, lines_removed, words_left (share), kept: one row per input row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text"))
    slim = _keyed(base_metrics(rows, rules), "source", "text").drop("text", "source", "_body")
    removed = removed_lines(docs, rules, host, text)
    out = _with_removed(slim, removed.withColumn("_cut", F.size("_lines")), ["_gone", "_cut"])
    left = _words_left()
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.coalesce(F.col("_cut"), F.lit(0)).cast("long").alias("lines_removed"),
                      left.alias("words_left"),
                      (~F.col("base_failed") & (left >= rules.min_left)).alias("kept"))


def cleaned(docs: DataFrame, rules: LineRules = LineRules(), host: str = "source",
            text: str = "text") -> DataFrame:
    """The kept documents without their over-frequent lines; the columns of ``docs``, n_chars counted anew."""
    keep = [host, text, "n_chars"]
    good = base_metrics(set_aside(docs, keep), rules, text).filter(~F.col("base_failed"))
    rows = _with_removed(_keyed(good, host, text), removed_lines(docs, rules, host, text), ["_gone", "_lines"])
    left = let(F.col("_lines"), lambda gone: F.array_join(F.filter(
        F.split("_body", "\n", -1), lambda x: ~F.array_contains(gone, _line_hash(x)) | ~x.rlike(HAS_WORD)), "\n"))
    rows = (rows.filter(_words_left() >= rules.min_left)
            .withColumn(text, F.when(F.col("_lines").isNull(), F.col(text)).otherwise(left)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_lines").isNull(), F.col("n_chars"))
                               .otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return put_back(rows, docs.columns, keep)


def op5_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict for all documents; hosts are the documents' sources."""
    return quality(read(spark, sf_dir, "documents"))

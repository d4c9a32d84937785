"""Operator 2: chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it are the
context and only its reply is trainable. Turns after the last reply (or a
conversation without any) end in one example with nothing to train on, so the
examples hold every turn and the conversation can be read back from them.

A turn is written as ``<|turn|>role<|text|>text<|end|>``. In roles and texts a
backslash is doubled and every control string gets a backslash after its first
character, so no control string of a text survives and ``unescape`` restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import read

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# openings of the control strings that a text must not pass on
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]"]
PROBE = "</s>[INST] ok [/INST]"


def escape(c: Column) -> Column:
    out = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        out = F.replace(out, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return out


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\(\\?)", "$1")


def prefix_examples(turns: DataFrame, target: str = "assistant") -> DataFrame:
    """conv_id, example, n_turns, text, loss_start, loss_end, trainable.

    ``loss_start`` and ``loss_end`` are code point offsets into ``text``. Turns
    are ordered by turn (null first), then role and text, so ties and repeated
    rows have one order; null roles and texts count as empty; a null conv_id is a
    conversation like any other; further columns are ignored. One conversation is
    one row while it is built; an example's text holds its whole context.
    """
    convs = (turns.groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_t")))
    convs = convs.select("conv_id", F.transform("_t", lambda t: F.struct(
        F.coalesce(t["role"] == target, F.lit(False)).alias("reply"),
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
        escape(t["text"]).alias("body"))).alias("_s"))
    n = F.size("_s")
    ends = F.filter(F.transform("_s", lambda s, i: F.when(s["reply"] | (i == n - 1), i)), lambda i: i.isNotNull())
    out = convs.select("conv_id", "_s", F.posexplode(ends).alias("example", "_end"))
    out = out.select(
        "conv_id", "example", (F.col("_end") + 1).alias("n_turns"), F.get("_s", F.col("_end")).alias("_last"),
        F.array_join(F.transform(F.slice("_s", F.lit(1), F.col("_end")),
                                 lambda s: F.concat(s["head"], s["body"], F.lit(END))), "").alias("_context"))
    start = F.length("_context") + F.length("_last.head")
    return out.select(
        "conv_id", "example", "n_turns", F.concat("_context", "_last.head", "_last.body", F.lit(END)).alias("text"),
        F.when(F.col("_last.reply"), start).otherwise(0).alias("loss_start"),
        F.when(F.col("_last.reply"), start + F.length("_last.body")).otherwise(0).alias("loss_end"),
        F.col("_last.reply").alias("trainable"))


def read_back(text: Column) -> Column:
    """The turns of an example's text: array of (role, text)."""
    parts = F.filter(F.split(text, r"<\|end\|>", -1), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.replace(p, F.lit(TURN), F.lit("")), TEXT, 1)).alias("role"),
        unescape(F.substring_index(p, TEXT, -1)).alias("text")))


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation: what its examples say, read back from their texts."""
    masked = unescape(F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    per = (examples.select("conv_id", "example", "text", F.when(F.col("trainable"), masked).otherwise("").alias("m"))
           .groupBy("conv_id")
           .agg(F.max_by("text", "example").alias("longest"), F.count("*").alias("n_examples"),
                F.sum(F.length("text")).alias("formatted_chars"),
                F.sort_array(F.collect_list(F.struct("example", "m"))).alias("m")))
    per = per.select("conv_id", "n_examples", "formatted_chars", read_back(F.col("longest")).alias("turns"),
                     F.array_join(F.transform("m", lambda x: x["m"]), "").alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(whole, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_examples")


def op2_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe conversation -7, expanded and read back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                 F.lit("user").alias("role"), F.lit(PROBE).alias("text")),
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"),
                 F.lit("assistant").alias("role"), F.lit(PROBE).alias("text")))).alias("r")).select("r.*")
    return digest(prefix_examples(turns.unionByName(probe)))


def _sql_escape(c: str) -> str:
    out = f"replace(coalesce({c}, ''), '\\', '\\\\')"
    for s in CONTROL:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


OP2_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
s AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, coalesce(role = 'assistant', false) AS reply,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length({_sql_escape('role')}) + length({_sql_escape('text')}) + {len(TURN + TEXT + END)})
           OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(x)) FILTER (WHERE reply), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE reply), '')) AS loss_sha256,
       (sum(upto) FILTER (WHERE reply OR i = n))::BIGINT AS formatted_chars,
       count(*) FILTER (WHERE reply OR i = n) AS n_examples
FROM s GROUP BY conv_id
"""

"""Operator 4: URL filters by a temporal list join (DataFrame functions only).

Dated list entries (add or remove a key) become validity intervals: an entry holds
until the next entry of its list and key. A capture looks up its host, the host's
parent domains and its host with the first path segment, each as of its fetch
time, so a list that changes later never changes an old verdict. The most specific
key decides; among lists of equal keys deny precedes allow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import read

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)"


@dataclass(frozen=True)
class ListRules:
    bucket_days: int = 30   # intervals and captures meet by key and time bucket


def intervals(entries: DataFrame) -> DataFrame:
    """list, key, valid_from, valid_to (null: open): when each key was on its list.

    ``entries``: list, key, day, action (add, remove). Entries of one day are taken
    with remove last; entries with a null among them say nothing and are left out;
    repeated entries give no second interval.
    """
    order = Window.partitionBy("list", "key").orderBy("day", "action")
    e = entries.select("list", "key", "day", "action").dropna().distinct()
    e = e.select("*", F.lead("day").over(order).alias("valid_to"))
    return (e.filter("action = 'add'").filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("day")))
            .select("list", "key", F.col("day").alias("valid_from"), "valid_to"))


def keys_of(captures: DataFrame) -> DataFrame:
    """Add host and ``keys``: (key, rank) from the most specific, without repeats."""
    host = F.nullif(F.lower(F.regexp_extract("url", HOST, 1)), F.lit(""))
    c = captures.select("*", host.alias("host"), F.nullif(F.regexp_extract("url", SEGMENT, 1), F.lit("")).alias("_seg"))
    c = c.withColumn("_labels", F.split("host", r"\."))
    n = F.size("_labels")
    parents = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.array_join(F.slice("_labels", i, n), ".").alias("key"), (n - i + 1).alias("rank")))
    path = F.when(F.col("_seg").isNotNull(), F.array(F.struct(
        F.concat_ws("/", "host", "_seg").alias("key"), (n + 1).alias("rank")))).otherwise(
        F.slice(parents, 1, 0))
    return c.withColumn("keys", F.when(F.col("host").isNotNull(), F.concat(path, parents))).drop("_seg", "_labels")


def temporal_verdicts(captures: DataFrame, entries: DataFrame, rules: ListRules = ListRules()) -> DataFrame:
    """page_id, url, host, fetch_day, n_active, matched_key, matched_list, listed_since, verdict.

    ``captures``: page_id, url, fetch_day. ``verdict`` is deny, allow or unlisted. A
    null or unparsable url, or a null day, is unlisted; equal captures each get a
    row; further columns are ignored; empty tables give no rows, or no lists.

    Captures and intervals meet by equi-join on key and time bucket, so a key that
    half the web shares is split by time, and by the engine's skew splitting of the
    captures; at most one interval of a list and key holds at a time.
    """
    b = F.lit(rules.bucket_days)
    one = captures.groupBy("page_id", "url", "fetch_day").agg(F.count("*").alias("_k"))
    found = keys_of(one).withColumn("_b", F.floor(F.col("fetch_day") / b))
    end = F.lit(captures.agg(F.max("fetch_day")).first()[0]).cast("long") + 1
    spans = intervals(entries).withColumn("_to", F.least(F.coalesce("valid_to", end), end)).filter("_to > valid_from")
    spans = spans.select(
        "list", F.col("key").alias("_key"), "valid_from", "_to",
        F.explode(F.sequence(F.floor(F.col("valid_from") / b), F.floor((F.col("_to") - 1) / b))).alias("_sb"))
    asked = found.select("page_id", "url", "fetch_day", "_b", F.explode("keys").alias("_q"))
    hit = asked.join(spans, (F.col("_q.key") == F.col("_key")) & (F.col("_b") == F.col("_sb"))
                     & (F.col("fetch_day") >= F.col("valid_from")) & (F.col("fetch_day") < F.col("_to")))
    best = hit.groupBy("page_id", "url", "fetch_day").agg(
        F.count("*").alias("n_active"),
        F.max(F.struct(F.col("_q.rank").alias("rank"), F.col("list"), F.col("_q.key").alias("key"),
                       F.col("valid_from"))).alias("_m"))
    best = best.select(F.col("page_id").alias("_p"), F.col("url").alias("_u"), F.col("fetch_day").alias("_d"), "n_active", "_m")
    out = found.join(best, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("url") == F.col("_u"))
                     & (F.col("fetch_day") == F.col("_d")), "left")
    return out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))).alias("_i")).select(
        "page_id", "url", "host", "fetch_day", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("_m.key").alias("matched_key"), F.col("_m.list").alias("matched_list"),
        F.col("_m.valid_from").alias("listed_since"), F.coalesce("_m.list", F.lit("unlisted")).alias("verdict"))


FETCH_DAY = "(page_id * 37) % 360"
# letter i of the key's digest as a number; keys are listed by it on days of the year
_D = "ascii(substr(md5({k}), {i}, 1))"


def _entry_sql(keys: str) -> str:
    """Dated entries for the keys of the pages: hosts, domains and host/segment; as Spark and DuckDB read it."""
    d = lambda i: _D.format(k="k", i=i)
    base = (f"SELECT k, CASE WHEN {d(1)} % 4 = 0 THEN 'allow' ELSE 'deny' END AS list, "
            f"({d(2)} * 3 + {d(3)}) % 300 AS d1, 10 + {d(4)} % 50 AS len, {d(5)} % 3 AS again FROM ({keys}) q "
            f"WHERE {d(6)} % 3 = 0")
    return (f"WITH b AS ({base}) SELECT list, k AS key, d1 AS day, 'add' AS action FROM b "
            "UNION ALL SELECT list, k, d1 + len, 'remove' FROM b WHERE again > 0 "
            "UNION ALL SELECT list, k, d1 + 2 * len, 'add' FROM b WHERE again > 1")


def derived_entries(captures: DataFrame) -> DataFrame:
    """List entries for keys that occur in the captures: one key in three is listed at some time."""
    keys = keys_of(captures).select(F.explode("keys.key").alias("k")).distinct()
    keys.createOrReplaceTempView("_list_keys")
    return captures.sparkSession.sql(_entry_sql("SELECT k FROM _list_keys"))


def op4_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, fetched on days given by their ids, against dated lists of their own keys."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.expr(FETCH_DAY).alias("fetch_day"))
    return temporal_verdicts(pages, derived_entries(pages))


OP4_SQL = f"""
WITH c AS (
  SELECT page_id, url, {FETCH_DAY} AS fetch_day,
         nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
         nullif(regexp_extract(url, '{SEGMENT}', 1), '') AS seg
  FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM c),
ks AS (
  SELECT page_id, url, fetch_day, array_to_string(labels[i:], '.') AS key, len(labels) - i + 1 AS rank
  FROM l, LATERAL (SELECT unnest(range(1, len(labels) + 1)) AS i)
  UNION ALL
  SELECT page_id, url, fetch_day, host || '/' || seg, len(labels) + 1 FROM l WHERE host IS NOT NULL AND seg IS NOT NULL),
e AS ({_entry_sql("SELECT DISTINCT key AS k FROM ks")}),
v AS (SELECT list, key, action, day AS valid_from,
             lead(day) OVER (PARTITION BY list, key ORDER BY day, action) AS valid_to FROM e),
h AS (
  SELECT ks.page_id, ks.url, ks.fetch_day, ks.key, ks.rank, v.list, v.valid_from,
         row_number() OVER (PARTITION BY page_id, url, fetch_day ORDER BY rank DESC, list DESC, ks.key DESC, valid_from DESC) AS r,
         count(*) OVER (PARTITION BY page_id, url, fetch_day) AS n
  FROM ks JOIN v ON ks.key = v.key AND v.action = 'add' AND ks.fetch_day >= v.valid_from
                AND (v.valid_to IS NULL OR ks.fetch_day < v.valid_to))
SELECT c.page_id, c.url, c.host, c.fetch_day, coalesce(h.n, 0)::BIGINT AS n_active, h.key AS matched_key,
       h.list AS matched_list, h.valid_from AS listed_since, coalesce(h.list, 'unlisted') AS verdict
FROM c LEFT JOIN h ON c.page_id = h.page_id AND c.url = h.url AND c.fetch_day = h.fetch_day AND h.r = 1
"""

"""Joins used by the checks.

Which side is broadcast is left to AQE, which decides at run time from measured
bytes and splits skewed partitions of shuffle joins. Checks that compare two
large tables aggregate each side to distinct keys with counts *before* the
shuffle, so a key that holds a third of all rows reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(required: DataFrame, existing: DataFrame, key: str,
             status_col: str = "status") -> DataFrame:
    """Required names LEFT JOIN existing names -> ``OK`` / ``FALTA``."""
    ex = existing.select(F.col(key)).distinct().withColumn("_hit", F.lit(True))
    return (required.join(ex, key, "left")
            .withColumn(status_col, F.when(F.col("_hit").isNull(), F.lit("FALTA"))
                        .otherwise(F.lit("OK")))
            .drop("_hit"))


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                count_col: str = "n_rows") -> DataFrame:
    """Keys of ``child`` with no row in ``parent``, with the number of
    child rows per key. Child rows are pre-aggregated per key (map-side partial
    aggregation) before the anti join, so a hot key does not skew the join."""
    per_key = child.groupBy(F.col(child_key)).agg(F.count(F.lit(1)).alias(count_col))
    parents = (parent.select(F.col(parent_key).alias(child_key)).distinct()
               .withColumn("_parent", F.lit(True)))
    # LEFT join + NULL test instead of LEFT ANTI: Catalyst would push an anti
    # join below the aggregate and shuffle raw child rows by key (a hot key
    # skews that shuffle). This way the aggregate's own exchange already
    # partitions the distinct keys, and only the parent keys move to meet them.
    return (per_key.join(parents, child_key, "left")
            .where(F.col("_parent").isNull()).drop("_parent"))


def valid_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key exists in the parent (left semi join)."""
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.join(parents, child_key, "left_semi")


def companion_repeats(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``keys..., n_left, n_right`` of the keys that both sides repeat. Each side is
    counted before they meet, and only repeated keys reach the join."""
    keys = list(keys)

    def many(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
    return many(left, "n_left").join(many(right, "n_right"), keys)


def companion(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Rows of a report with their companion report rows by key.

    A key that both sides repeat does not say which row belongs to which: it is left out
    and reported by ``companion_repeats``. Every other key is single on one side, so the
    result has no more rows than both sides together, whatever the keys hold."""
    keys = list(keys)
    unclear = companion_repeats(left, right, keys).select(*keys)
    return left.join(unclear, keys, "left_anti").join(right, keys, how)


def catalog_violations(df: DataFrame, column: str, catalog: DataFrame, report: str,
                       key_col: str = "key", pad_width: int | None = None) -> DataFrame:
    """Values of ``column`` not in the catalog, with their counts.

    Values are counted first (partial aggregation: one row per distinct value
    per task), then anti-joined with the catalog. ``pad_width`` normalises mixed-format keys (``'000111'``
    as text, ``780`` as a number) to zero-padded text on both sides (V9)."""
    from periodica.functions.scalar import zero_pad

    def norm(c):
        c = F.col(c).cast("string")
        return zero_pad(c, pad_width) if pad_width else c
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(norm(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    cat = catalog.select(norm(key_col).alias("value")).distinct()
    return (counts.join(cat, "value", "left_anti")
            .select(F.lit(report).alias("report"), F.lit(column).alias("column"), "value", "n_rows"))


def violation_lines(violations: DataFrame, width: int = 4000) -> DataFrame:
    """A3: the offending values of each (report, column), ascending, joined into lines of
    about ``width`` characters (``operators.ordered.accumulate``)."""
    from periodica.operators.ordered import accumulate
    return accumulate(violations, ["report", "column"], "value", width, out="values")


def violation_summary(violations: DataFrame) -> DataFrame:
    """One line per (report, column): total offending rows, number of distinct
    offending values and their smallest / largest value; the values themselves are in
    ``violation_lines``."""
    return (violations.groupBy("report", "column")
            .agg(F.sum("n_rows").alias("n_rows"),
                 F.count(F.lit(1)).alias("n_values"),
                 F.min("value").alias("min_value"), F.max("value").alias("max_value")))


def catalog_columns(spark, tables: list[str]) -> DataFrame:
    """``(table, column, type)`` of catalog tables, from the catalog's own
    metadata (the counterpart of the server's objects / columns views)."""
    rows = [(t, c.name, c.dataType) for t in tables if spark.catalog.tableExists(t)
            for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, "table string, column string, type string")


def required_columns(required: DataFrame, existing: DataFrame) -> DataFrame:
    """J1 + J2: required ``(table, column)`` pairs LEFT JOIN the catalog's
    columns -> ``OK`` / ``FALTA`` (names compared case-insensitively)."""
    ex = existing.select(F.lower("table").alias("_t"), F.lower("column").alias("_c"),
                         F.lit(True).alias("_hit")).distinct()
    r = required.withColumn("_t", F.lower("table")).withColumn("_c", F.lower("column"))
    return (r.join(ex, ["_t", "_c"], "left")
            .withColumn("status", F.when(F.col("_hit").isNull(), F.lit("FALTA")).otherwise(F.lit("OK")))
            .drop("_t", "_c", "_hit"))


def report_catalog_violations(spec, df: DataFrame, catalogs: dict[str, DataFrame],
                              key_col: str = "key") -> DataFrame | None:
    """J5 / V7 / V9 for one report: every layout column bound to a catalog
    (``layouts.CATALOG_BINDINGS``) is checked against that catalog when it is
    supplied; returns ``(report, column, value, n_rows)`` or None when no bound
    catalog was given. One counting pass per bound column."""
    from periodica.layouts import CATALOG_BINDINGS
    frames = [catalog_violations(df, field, catalogs[name], spec.name, key_col, pad)
              for field, name, pad in CATALOG_BINDINGS.get(spec.numero, ())
              if name in catalogs and field in df.columns]
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

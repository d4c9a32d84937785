"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile

import periodica
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.session import ensure_shared_dir

# a word, as the contracts define it: a run of characters other than space and \t..\r
WORD_SPLIT = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(periodica.__file__))
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "periodica"), "zip",
                                   os.path.dirname(package), os.path.basename(package))
        sc.addPyFile(made)
        _shipped.add(sc.applicationId)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def set_aside(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` as columns and all others in ``_rest``, so that no helper column clashes with them."""
    rest = [c for c in docs.columns if c not in keep]
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c in keep],
                       F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(None).alias("_none")]).alias("_rest"))


def put_back(rows: DataFrame, columns: list[str], keep: list[str], *more: Column) -> DataFrame:
    """The columns that ``set_aside`` took, in their old order, and ``more``."""
    return rows.select(*[F.col(f"`{c}`") if c in keep else F.col("_rest").getField(c).alias(c) for c in columns], *more)


def hashed_share(h: Column, want: int, of: int) -> Column:
    """True for about ``want`` of ``of`` distinct values of a 64-bit hash, always the same ones."""
    if of <= want:
        return F.lit(True)
    return h < F.lit(int(-2 ** 63 + want / of * 2 ** 64)).cast("long")


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks_for(rows: int, per_chunk: int = 20_000) -> int:
    """Number of hash chunks that keeps a chunk near ``per_chunk`` rows at any input size."""
    return max(8, -(-rows // per_chunk))


def running_start(df: DataFrame, group: list[str], order: list[str], amount: str, chunks: int,
                  out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows of the same group that come before.

    Rows are dealt into hash chunks of their order columns, so no task holds a
    whole group: chunk totals (one row per group and chunk) are summed in chunk
    order, then each chunk is numbered by itself. Rows equal in every order
    column are interchangeable; the result does not depend on the partitioning.
    ``df`` is read twice and should be cut or cheap.
    """
    def dealt(d: DataFrame) -> DataFrame:
        return d.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    rows = dealt(df)
    totals = dealt(df).groupBy(*group, "_chunk").agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                           F.col("_chunk").alias("_c"),
                           F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = (Window.partitionBy(*group, "_chunk").orderBy(F.xxhash64(F.lit("o"), *order), *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    match = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    cond = F.col("_chunk") == F.col("_c")
    for m in match:
        cond = cond & m
    return (rows.join(totals, cond)
            .withColumn(out, (F.col("_base") + F.col("_in")).cast("long"))
            .drop("_chunk", "_c", "_base", "_in", *[f"_g{i}" for i in range(len(group))]))

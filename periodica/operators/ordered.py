"""Order made visible: line numbers of a sorted delivery (A4) and strings
accumulated over rows in order (A3), for data of any size and any group of it.

Rows are sorted by ranges of group and order together, so a group that holds a third
of all rows is spread over tasks; the sorted rows are checkpointed, which fixes
their partitions; each task then sums up its own part, and one row for each group
and partition carries the sum of the parts before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica.session import ensure_shared_dir

BEFORE = (Window.unboundedPreceding, -1)
TASK_ROWS = 100_000     # of a range of rows, about: more rows make more ranges, whatever the session's partitions


def running_total(df: DataFrame, group: list[str], order: list[Column], amount: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows of the group that come before, in
    the given order. Rows that are equal in all of it come in any order, so give an
    order without ties where that matters. ``df`` is read twice: its rows are counted first."""
    ensure_shared_dir(df.sparkSession)
    keys, n = [F.col(c) for c in group] + order, df.count() // TASK_ROWS + 1
    rows = (df.withColumn("_amount", amount.cast("long")).repartitionByRange(n, *keys)
            .sortWithinPartitions(*keys).checkpoint(eager=True))
    rows = rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_i"))
    parts = rows.groupBy(*group, "_part").agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(*group or [F.lit(0)]).orderBy("_part").rowsBetween(*BEFORE)
    parts = parts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_part").alias("_p"),
                         F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, "_part").orderBy("_i").rowsBetween(*BEFORE)
    # a task takes a few ranges, not a share of all rows
    rows = rows.repartition(n, "_part").withColumn("_in", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(parts, same).withColumn(out, F.col("_base") + F.col("_in")).select(*df.columns, out)


def numbered_lines(df: DataFrame, order: list[Column], out: str = "line") -> DataFrame:
    """A4: each row with its number, from 1, in the order of a sorted delivery."""
    return running_total(df, [], order, F.lit(1), "_before").withColumn(out, F.col("_before") + 1).drop("_before")


def accumulate(df: DataFrame, group: list[str], value: str, width: int, sep: str = ", ", out: str = "text") -> DataFrame:
    """A3: the values of each group joined into lines, ascending: ``group..., line_no, out``.

    The whole string is cut into lines of ``width`` characters where a value begins at
    or behind a multiple of it, so a line holds whole values, is never longer than
    ``width`` and the longest value together, and no value is left out. NULL values
    add nothing, as they would turn the legacy accumulation to NULL."""
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("string").alias("_value"))
    at = running_total(rows, group, [F.col("_value")], F.length("_value") + len(sep), "_start")
    lines = at.groupBy(*group, F.floor(F.col("_start") / width).alias("_line")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_start", "_value"))), lambda v: v["_value"]), sep).alias(out))
    # lines without a value that begins there are not counted
    place = Window.partitionBy(*group).orderBy("_line")
    return lines.select(*group, F.row_number().over(place).alias("line_no"), out)

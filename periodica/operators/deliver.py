"""Report delivery (S19, D*): one window, layout columns in layout order, dates
rendered as the layout asks, audit and hidden columns left out.

Plan shape: partition-pruned scan of one ``period_start`` partition -> Filter ->
Project (one stage, no shuffle). Only the two reports with a declared order
(212, 213) add a range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.formats import render_date
from periodica.functions.periods import Window
from periodica.operators.ordered import numbered_lines
from periodica.sources.tables import scan_window
from periodica.spec import ID_COL, ReportSpec


def delivery_columns(spec: ReportSpec) -> list[Column]:
    """Layout projection: formatted dates, case-exact headers (X-1..X-3, X-21)."""
    out = []
    for c in spec.columns:
        expr = render_date(c.name, c.fmt) if c.fmt else F.col(c.name)
        out.append(expr.alias(c.header))
    return out


def deliver_rows(df: DataFrame, spec: ReportSpec, window: Window,
                 partitioned: bool = True) -> DataFrame:
    """Delivery of ``window`` from any frame holding the stored columns."""
    rows = scan_window(df, spec.control, window, partitioned=partitioned)
    if spec.sort:
        keys = [F.col(c).asc_nulls_first() for c in spec.sort]
        # unique tie-breaker: equal sort keys (one value may hold a third of a
        # window) can still be split across range partitions, and the order of
        # ties is deterministic from run to run
        if ID_COL in rows.columns:
            keys.append(F.col(ID_COL).asc())
        rows = rows.orderBy(*keys)
    return rows.select(*delivery_columns(spec))


def write_delivery(df: DataFrame, path: str, sep: str = "|") -> None:
    """Write the delivered frame as delimited text with a header line.

    Each task writes its own part file (no single-task funnel); ordered
    deliveries keep their order across part files because the sort is a
    range partitioning.
    """
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
       .option("encoding", "UTF-8").option("nullValue", "").option("emptyValue", "")
       .csv(path))


def delivered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): the lines of a written delivery below its headers, numbered from 1 as
    they stand: part file by part file, and line by line in each."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_at"))
    lines = lines.withColumn("_row", F.monotonically_increasing_id())
    # the header is the first line of a file
    first = lines.groupBy("_file").agg(F.min(F.struct("_at", "_row")).alias("_first"))
    body = lines.join(first, "_file").where((F.col("_at") != F.col("_first._at")) | (F.col("_row") != F.col("_first._row")))
    return numbered_lines(body, [F.col("_file"), F.col("_at"), F.col("_row")]).select("line", "value")

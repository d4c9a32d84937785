"""Window agreement (P6) and change of a report's frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.functions.periods import period_start
from periodica.spec import PERIOD_COL, ReportSpec


def repartition_periods(df: DataFrame, control: str, new_frequency: str) -> DataFrame:
    """Rows of a stored report re-keyed to the periods of another frequency
    (P7); writing the result partitioned by ``period_start`` moves every row
    into its new window in one job."""
    return df.withColumn(PERIOD_COL, period_start(control, new_frequency))


def rows_per_period(df: DataFrame, control: str, frequency: str, out: str = "n_rows") -> DataFrame:
    """Row count per period of ``frequency`` (one row per period)."""
    return (df.groupBy(period_start(control, frequency).alias(PERIOD_COL))
            .agg(F.count(F.lit(1)).alias(out)))


def period_digest(df: DataFrame, control: str, frequency: str, columns: list[str]) -> DataFrame:
    """Per period, the row count and a digest of the rows' ``columns`` that no order of
    rows changes: sum and xor of two hashes of each row (``n_rows``, ``digest_sum``,
    ``digest_xor``). Summed up in every task first, one row per period and task."""
    row = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return (df.groupBy(period_start(control, frequency).alias(PERIOD_COL))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias("digest_sum"),
                 F.bit_xor(F.xxhash64(F.lit("row"), *row)).alias("digest_xor")))


DIGEST = ("digest_sum", "digest_xor")


def window_drift(loaded: DataFrame, delivered: DataFrame) -> DataFrame:
    """P6 data check: per period, rows loaded vs rows delivered (full outer join of the
    two tables of ``rows_per_period`` or ``period_digest``). ``drift`` is the difference
    of the counts; with digests, ``same_rows`` tells whether the rows are the same,
    which equal counts do not."""
    digests = [c for c in DIGEST if c in loaded.columns and c in delivered.columns]
    j = (loaded.select(PERIOD_COL, F.col("n_rows").alias("loaded"), *[F.col(c).alias(f"l_{c}") for c in digests])
         .join(delivered.select(PERIOD_COL, F.col("n_rows").alias("delivered"), *[F.col(c).alias(f"d_{c}") for c in digests]),
               PERIOD_COL, "full_outer"))
    out = [PERIOD_COL, F.coalesce("loaded", F.lit(0)).alias("loaded"), F.coalesce("delivered", F.lit(0)).alias("delivered"),
           (F.coalesce("loaded", F.lit(0)) - F.coalesce("delivered", F.lit(0))).alias("drift")]
    if digests:
        same = F.coalesce("loaded", F.lit(0)) == F.coalesce("delivered", F.lit(0))
        for c in digests:
            same = same & F.col(f"l_{c}").eqNullSafe(F.col(f"d_{c}"))
        out.append(same.alias("same_rows"))
    return j.select(*out)


def windows_agree(load_spec: ReportSpec, deliver_spec: ReportSpec) -> bool:
    """P6 spec rule: a report's load and delivery use the same window."""
    return (load_spec.frequency == deliver_spec.frequency
            and load_spec.control == deliver_spec.control)


def change_frequency(spark, table: str, spec: ReportSpec, new_frequency: str) -> ReportSpec:
    """Move every stored row of a report to the periods of a new frequency
    (one distributed rewrite, then a swap) and return the new spec."""
    from periodica.operators.migrate import swap_rewrite
    df = spark.table(table)
    swap_rewrite(spark, table, repartition_periods(df, spec.control, new_frequency))
    return spec.with_version(frequency=new_frequency)

"""Report specs over the shared test tables, used by the registered queries and
the benchmark: ``orders`` is a landing table with control date ``o_orderdate``,
``lineitem`` a wide landing table on ``l_shipdate``, ``events`` a landing table
keyed by its load time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import DAILY, MONTHLY, QUARTERLY, WEEKLY, minute_rounded
from periodica.spec import ID_COL, LOAD_TS_COL, ReportSpec, parse_layout

ORDERS_LAYOUT = ("o_orderkey bigint | o_custkey bigint | o_orderstatus varchar(1) | "
                 "o_totalprice numeric(12,2) | o_orderdate date ymd | o_orderpriority varchar(15)")
LINEITEM_LAYOUT = ("l_orderkey bigint | l_partkey bigint | l_suppkey bigint | l_linenumber int | "
                   "l_quantity numeric(12,2) | l_extendedprice numeric(12,2) | "
                   "l_discount numeric(4,2) | l_tax numeric(4,2) | l_returnflag varchar(1) | "
                   "l_linestatus varchar(1) | l_shipdate date ymd")
# A stricter layout for the same rows: extended prices above 99,999.99 do not fit.
LINEITEM_STRICT_LAYOUT = LINEITEM_LAYOUT.replace("l_extendedprice numeric(12,2)",
                                                 "l_extendedprice numeric(7,2)")
EVENTS_LAYOUT = "event_id bigint | user_id bigint | event_type varchar(20) | value numeric(12,2)"


def orders_spec(frequency: str = MONTHLY, **kw) -> ReportSpec:
    return ReportSpec(numero=901, name="901_ORDERS", frequency=frequency,
                      control="o_orderdate", columns=parse_layout(ORDERS_LAYOUT), **kw)


def lineitem_spec(frequency: str = MONTHLY, strict: bool = False, **kw) -> ReportSpec:
    layout = LINEITEM_STRICT_LAYOUT if strict else LINEITEM_LAYOUT
    return ReportSpec(numero=902, name="902_LINEITEM" + ("_STRICT" if strict else ""),
                      frequency=frequency, control="l_shipdate",
                      columns=parse_layout(layout), **kw)


def events_spec() -> ReportSpec:
    """Weekly on the load time, as the report whose file carries no date."""
    return ReportSpec(numero=903, name="903_EVENTS", frequency=WEEKLY, control=LOAD_TS_COL,
                      columns=parse_layout(EVENTS_LAYOUT))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_landing(df: DataFrame, key: list[str], load_ts=None) -> DataFrame:
    """Add the landing audit columns to a test table: a stable ``ID`` built from
    the business key and a load time (a column, or a fixed literal)."""
    ident = F.concat_ws("-", *[F.col(k).cast("string") for k in key])
    ts = load_ts if load_ts is not None else F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumn(ID_COL, ident).withColumn(LOAD_TS_COL, ts)


def orders_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_landing(table(spark, sf_dir, "orders"), ["o_orderkey"])


def lineitem_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_landing(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def events_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.ts`` plays the load time, stored rounded to the minute."""
    return as_landing(table(spark, sf_dir, "events"), ["event_id"], minute_rounded("ts"))


FREQS = {"daily": DAILY, "weekly": WEEKLY, "monthly": MONTHLY, "quarterly": QUARTERLY}

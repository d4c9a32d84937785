"""Registered queries for the ways in which rows could get lost or doubled:
windows of another frequency than the stored one, late landing months, empty and
unparsable backfills, replays, and quarantines shared by reports.
"""

from __future__ import annotations

import datetime as dt
import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import DAILY, MONTHLY, WEEKLY, window_for
from periodica.operators.deliver import deliver_rows
from periodica.plans import reports
from periodica.plans import testdata as td
from periodica.plans.registry import (_INGEST_SQL, _LANDED, DAY, ORACLE, ORDERS_INGEST, _misfit_sql, _orders_table,
                                      _routed, register, scratch_lake, sql_delivery_cols, sql_window, write_extract)
from periodica.session import unique_path
from periodica.spec import IngestSpec


class Broken(Exception):
    pass


@contextmanager
def broken(module, step: str):
    """A run breaks off where it would take this step."""
    kept = getattr(module, step)

    def stop(*_, **__):
        raise Broken(step)
    setattr(module, step, stop)
    try:
        yield
    except Broken:
        pass
    finally:
        setattr(module, step, kept)


def _other_frequency(stored: str, asked: str):
    spec, w = td.orders_spec(asked), window_for(DAY, asked)
    sql = f"SELECT {sql_delivery_cols(spec)} FROM orders WHERE {sql_window('o_orderdate', w.start, w.end)}"

    @register(f"deliver_{asked}_from_{stored}", sql)
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A window of one frequency from a table stored by another."""
        lake, kept, _ = _orders_table(spark, sf_dir, stored)
        return deliver_rows(spark.table(lake.report_table(kept)), spec, w, partitioned=True)
    return q


for _s, _a in ((MONTHLY, WEEKLY), (MONTHLY, DAILY), (WEEKLY, MONTHLY), (WEEKLY, DAILY), (DAILY, WEEKLY)):
    _other_frequency(_s, _a)


def _json_spec(**kw) -> IngestSpec:
    """The orders extract as a processor config in JSON."""
    j = {"processor_name": "ORDERS_JSON", "file_pattern": r"^part-.*\.csv$", "read_options": {"delimiter": "|"},
         "data_mapping": {"column_map": dict(ORDERS_INGEST.column_map),
                          "type_conversions": {"date_fields": ["o_orderdate"], "allow_empty": True,
                                               "numeric_fields": [c for c, _ in ORDERS_INGEST.numeric_fields]},
                          "final_db_columns": list(ORDERS_INGEST.final_columns)},
         "db_config": {"schema": "LMDA", "table_name": "ORDERS_JSON"}}
    return IngestSpec.from_json(json.dumps(j), dict(ORDERS_INGEST.numeric_fields), **kw)


_MONTH = window_for(DAY, MONTHLY)
_MONTH_SQL = (f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders "
              f"WHERE {sql_window('o_orderdate', _MONTH.start, _MONTH.end)}")
# the lowest priority arrives as an empty cell, which the extract's config allows
_ORDERS = td.orders_spec(MONTHLY)
_ORDERS_OPEN = _ORDERS.with_version(columns=tuple(
    type(c)(c.name, c.type, True, c.out, c.fmt) for c in _ORDERS.columns))


def _json_late(control_col):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Rows of March that land in another month are loaded into March, whether
        landing is partitioned by the control date or by the load month."""
        from periodica.sources.ingest import ingest
        lake, folder, ing = scratch_lake(spark), unique_path(spark, "drop"), _json_spec(control_col=control_col)
        write_extract(spark, sf_dir, folder)
        ingest(spark, lake, ing, _routed(spark, folder), now=dt.datetime(1995, 4, 20, 8, 0))
        fq = lake.fq("bronze", ing.landing_table)
        res = reports.load(spark, lake, _ORDERS_OPEN, DAY, landing=spark.table(fq), landing_control=lake.landing_control(fq))
        if not res.ok:
            raise RuntimeError(res.message)
        return spark.table(lake.report_table(_ORDERS_OPEN)).select("o_orderkey", "o_orderdate")
    return q


register("json_ingest_late_month", _MONTH_SQL)(_json_late(None))
register("json_ingest_by_control", _MONTH_SQL)(_json_late("o_orderdate"))


_ALL_SQL = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"


@register("backfill_empty_source", _ALL_SQL)
def backfill_empty_source(spark, sf_dir):
    """An unbounded backfill without rows changes nothing."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    out = reports.backfill(spark, lake, spec, td.orders_landing(spark, sf_dir).where("1 = 0"))
    if out:
        raise RuntimeError(f"{len(out)} windows changed")
    return spark.table(lake.report_table(spec)).select("o_orderkey", "o_orderdate")


@register("backfill_bad_dates", """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'quarantined' ELSE 'stored' END AS place, count(*) AS n,
       CASE WHEN o_orderkey % 10 = 0 THEN 'o_orderdate:date' END AS reason
FROM orders GROUP BY 1, 3""")
def backfill_bad_dates(spark, sf_dir):
    """every row of a backfill is stored or, when its control date does not
    convert, quarantined and counted."""
    lake, spec = scratch_lake(spark), td.orders_spec(MONTHLY)
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("no date")).otherwise(F.to_date("o_orderdate").cast("string"))
    results = reports.backfill(spark, lake, spec, td.orders_landing(spark, sf_dir).withColumn("o_orderdate", text))
    lost = sum(r.rejected for r in results if r.window is None)
    stored = spark.table(lake.report_table(spec)).groupBy(
        F.lit("stored").alias("place"), F.lit(None).cast("string").alias("reason")).agg(F.count("*").alias("n"))
    held = spark.table(lake.fq("silver", "quarantine")).groupBy(F.lit("quarantined").alias("place"), "reason").agg(
        F.count("*").alias("n")).where(F.col("n") == lost)
    return stored.unionByName(held).select("place", "n", "reason")


@register("backfill_vs_load", f"""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate, n.w AS way
FROM orders, (VALUES ('load'), ('backfill')) AS n(w) WHERE {sql_window('o_orderdate', _MONTH.start, _MONTH.end)}""")
def backfill_vs_load(spark, sf_dir):
    """A backfilled window has the rows of a load, the injected date included."""
    spec = td.orders_spec(MONTHLY).with_version(inject="period_start", inject_col="o_orderdate")
    landing, out = td.orders_landing(spark, sf_dir), None
    for way in ("load", "backfill"):
        lake = scratch_lake(spark)
        results = ([reports.load(spark, lake, spec, DAY, landing=landing)] if way == "load"
                   else reports.backfill(spark, lake, spec, landing, first=DAY, last=DAY))
        if not all(r.ok for r in results):
            raise RuntimeError(results[0].message)
        rows = spark.table(lake.report_table(spec)).select("o_orderkey", "o_orderdate", F.lit(way).alias("way"))
        out = rows if out is None else out.unionByName(rows)
    return out


_LINES = td.lineitem_spec(MONTHLY, strict=True)
_LINE_MONTH = window_for(DAY, MONTHLY)
_BAD_ORDERS = "o_totalprice > 200000"


@register("quarantine_layouts", f"""
SELECT '[902_LINEITEM_STRICT]' AS job, CAST(date_trunc('month', l_shipdate) AS DATE) AS window_start, count(*) AS n
FROM lineitem WHERE {_misfit_sql(_LINES)} GROUP BY 2
UNION ALL
SELECT '[901_ORDERS]', DATE '{_MONTH.start}', count(*) FROM orders
WHERE {_BAD_ORDERS} AND {sql_window('o_orderdate', _MONTH.start, _MONTH.end)} HAVING count(*) > 0""")
def quarantine_layouts(spark, sf_dir):
    """V2: one quarantine takes rows of two layouts, from a backfill and from a load."""
    lake = scratch_lake(spark)
    reports.backfill(spark, lake, _LINES, td.lineitem_landing(spark, sf_dir))
    dear = F.when(F.expr(_BAD_ORDERS), F.lit(1e12)).otherwise(F.col("o_totalprice"))
    reports.load(spark, lake, td.orders_spec(MONTHLY), DAY,
                 landing=td.orders_landing(spark, sf_dir).withColumn("o_totalprice", dear))
    return spark.table(lake.fq("silver", "quarantine")).groupBy("job", "window_start").agg(F.count("*").alias("n"))


@register("run_log_table", f"""
SELECT '[901_ORDERS]' AS job, 'Exitoso' AS status, count(*) AS inserted
FROM orders WHERE {sql_window('o_orderdate', _MONTH.start, _MONTH.end)}
UNION ALL SELECT '[902_LINEITEM]', 'Error', 0 FROM (SELECT count(*) FROM lineitem) t""")
def run_log_table(spark, sf_dir):
    """Every load leaves a row in the log table, one that cannot even be analysed too."""
    lake = scratch_lake(spark)
    reports.load(spark, lake, td.orders_spec(MONTHLY), DAY, landing=td.orders_landing(spark, sf_dir))
    reports.load(spark, lake, td.lineitem_spec(MONTHLY), DAY, landing=td.lineitem_landing(spark, sf_dir).drop("l_tax"))
    return spark.table(lake.fq("silver", reports.RUN_LOG)).select(
        F.col("NombreJob").alias("job"), F.col("EstadoEjecucion").alias("status"), F.col("FilasInsertadas").alias("inserted"))


def _landed(spark: SparkSession, lake) -> DataFrame:
    return spark.table(lake.fq("bronze", ORDERS_INGEST.landing_table)).select(*_LANDED)


@register("stream_replay", _INGEST_SQL)
def stream_replay(spark, sf_dir):
    """A stream whose checkpoint is lost offers all files again; they land once."""
    from periodica.streaming.landing_stream import land_stream
    lake, folder = scratch_lake(spark), unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    for _ in range(2):
        land_stream(spark, lake, ORDERS_INGEST, folder, checkpoint=unique_path(spark, "stream-ckpt"))
    return _landed(spark, lake)


@register("stream_then_batch", _INGEST_SQL)
def stream_then_batch(spark, sf_dir):
    """Files landed by a stream are skipped by a batch."""
    from periodica.sources.ingest import ingest
    from periodica.streaming.landing_stream import land_stream
    lake, folder = scratch_lake(spark), unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    land_stream(spark, lake, ORDERS_INGEST, folder, checkpoint=unique_path(spark, "stream-ckpt"))
    ingest(spark, lake, ORDERS_INGEST, _routed(spark, folder))
    return _landed(spark, lake)


@register("ingest_crash_retry", ORACLE["ingest_roundtrip"] + """
UNION ALL SELECT CAST(o_orderkey AS DECIMAL(18,0)), CAST(o_custkey AS DECIMAL(18,0)), o_orderstatus,
       CAST(o_totalprice AS DECIMAL(12,2)), CAST(o_orderdate AS DATE), 'rejected'
FROM orders WHERE o_orderpriority = '5-LOW'""")
def ingest_crash_retry(spark, sf_dir):
    """A batch that broke off after landing its rows, before the manifest said so,
    is run again: rows and rejects are there once (S10)."""
    from periodica.sources import ingest as g
    lake, folder = scratch_lake(spark), unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    paths = _routed(spark, folder)
    with broken(g, "_add_manifest"):
        g.ingest(spark, lake, ORDERS_INGEST, paths)
    g.ingest(spark, lake, ORDERS_INGEST, paths)
    row = F.from_json("row", "o_orderkey decimal(18,0), o_custkey decimal(18,0), o_orderstatus string, "
                             "o_totalprice decimal(12,2), o_orderdate date")
    rejects = spark.table(lake.fq("bronze", "rejects")).select(row.alias("r")).select("r.*", F.lit("rejected").alias("o_orderpriority"))
    return _landed(spark, lake).unionByName(rejects)

"""Registered queries for runs that break off or run side by side: no window is
lost, no row lands twice, and every run leaves its log row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import DAILY, MONTHLY, QUARTERLY, WEEKLY, window_for
from periodica.layouts import SPECS
from periodica.operators import window_sink
from periodica.plans import reports
from periodica.plans import testdata as td
from periodica.plans.registry import (_LANDED, DAY, ORACLE, ORDERS_INGEST, _orders_table, _routed, register,
                                      scratch_lake, sql_delivery_cols, sql_window, write_extract)
from periodica.plans.report_queries import LINE_DAY, landing_frame, oracle
from periodica.plans.row_loss_queries import broken
from periodica.session import unique_path
from periodica.sources.ingest import ingest
from periodica.sources.versions import forget_windows

_SPEC = td.orders_spec(MONTHLY)
_MONTH = window_for(DAY, MONTHLY)
_MONTH_ORDERS = f"orders WHERE {sql_window('o_orderdate', _MONTH.start, _MONTH.end)}"
_MONTH_SQL = f"SELECT {sql_delivery_cols(_SPEC)}"


def failing(column: str) -> F.Column:
    """The column's value, but an error in the task that meets the last of its rows."""
    key = F.col("o_orderkey")
    return F.when(key % 7 == 3, F.raise_error(F.lit("executor lost")).cast("string")).otherwise(F.col(column))


def loaded(spark: SparkSession, sf_dir: str):
    lake = scratch_lake(spark)
    landing = td.orders_landing(spark, sf_dir)
    if not reports.load(spark, lake, _SPEC, DAY, landing=landing).ok:
        raise RuntimeError("first load failed")
    return lake, landing


def must_fail(result) -> None:
    if result.ok:
        raise RuntimeError("the run was meant to fail")


def reopened(spark: SparkSession, lake, spec) -> None:
    """What a new session finds: the catalog's definition is gone, the folders are there."""
    spark.sql(f"DROP TABLE {lake.report_table(spec)}")
    forget_windows(spark, lake.report_table(spec))
    lake.ensure_report_table(spec)


@register("swap_crash_keeps_window", f"{_MONTH_SQL} FROM {_MONTH_ORDERS}")
def swap_crash_keeps_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose task fails while it writes, one that breaks off before its
    commit, and a session that starts anew after both: the window keeps its rows."""
    lake, landing = loaded(spark, sf_dir)
    must_fail(reports.load(spark, lake, _SPEC, DAY, landing=landing.withColumn("o_orderpriority", failing("o_orderpriority"))))
    with broken(window_sink, "commit_window"):
        must_fail(reports.load(spark, lake, _SPEC, DAY, landing=landing.where("1 = 0")))
    reopened(spark, lake, _SPEC)
    return reports.deliver(spark, lake, _SPEC, DAY)


_SELF = _SPEC.with_version(source="self", inject="run_day", inject_col="o_orderdate")


@register("self_refresh_crash_keeps_window", f"{_MONTH_SQL} FROM {_MONTH_ORDERS}")
def self_refresh_crash_keeps_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a report that is its own source, where lost rows cannot be
    loaded again."""
    lake, _ = loaded(spark, sf_dir)
    inject = reports._inject
    reports._inject = lambda df, *a: inject(df, *a).withColumn("o_orderpriority", failing("o_orderpriority"))
    try:
        must_fail(reports.self_refresh(spark, lake, _SELF, DAY))
    finally:
        reports._inject = inject
    with broken(window_sink, "commit_window"):
        must_fail(reports.self_refresh(spark, lake, _SELF, DAY))
    reopened(spark, lake, _SPEC)
    return reports.deliver(spark, lake, _SPEC, DAY)


@register("crash_after_commit", f"""
{_MONTH_SQL.replace("strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d')", f"'{DAY:%Y/%m/%d}'")} FROM {_MONTH_ORDERS}""")
def crash_after_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh that broke off between its commit and the catalog is found by the next reader."""
    lake, _ = loaded(spark, sf_dir)
    with broken(window_sink, "point_windows"):
        if not reports.self_refresh(spark, lake, _SELF, DAY).ok:
            raise RuntimeError("the commit was made")
    return reports.deliver(spark, lake, _SPEC, DAY)


@register("backfill_crash", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, s.status
FROM orders, (VALUES ('Error')) AS s(status)""")
def backfill_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill over windows that exist fails in a task: all windows keep
    their rows, and the log has its row."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    landing = td.orders_landing(spark, sf_dir).withColumn("o_orderpriority", failing("o_orderpriority"))
    must_fail(reports.backfill(spark, lake, spec, landing)[0])
    reopened(spark, lake, spec)
    log = (spark.table(lake.fq("silver", reports.RUN_LOG)).where("EstadoEjecucion = 'Error'")
           .select(F.col("EstadoEjecucion").alias("status")))
    return spark.table(lake.report_table(spec)).select("o_orderkey", "o_orderdate").crossJoin(F.broadcast(log.limit(2)))


@register("backfill_twice", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start
FROM orders WHERE NOT (o_orderdate >= DATE '1995-03-01' AND o_orderdate < DATE '1995-04-01')""")
def backfill_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second backfill over windows that exist writes to no live folder, empties the
    window left without rows, and a new session finds the same."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    landing = td.orders_landing(spark, sf_dir)
    less = landing.where("NOT (o_orderdate >= DATE '1995-03-01' AND o_orderdate < DATE '1995-04-01')")
    results = reports.backfill(spark, lake, spec, less, first="1992-01-01", last="1999-12-31")
    if not all(r.ok for r in results):
        raise RuntimeError(results[0].message)
    reopened(spark, lake, spec)
    return spark.table(lake.report_table(spec)).select("o_orderkey", "o_orderdate", "period_start")


def side_by_side(jobs: list[Callable]) -> list:
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


_SIDE = (21, 50, 75, 84, 121, 122, 133, 154, 157, 209)


@register("parallel_loads", "\nUNION ALL ".join(
    f"SELECT '[{SPECS[n].name}]' AS job, 'Exitoso' AS status, count(*) AS inserted, count(*) AS stored "
    f"FROM ({oracle(SPECS[n], 'lineitem', LINE_DAY)}) t" for n in _SIDE))
def parallel_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten reports loaded at once, each with its log row and all its rows."""
    lake = scratch_lake(spark)
    side_by_side([lambda n=n: reports.load(spark, lake, SPECS[n], LINE_DAY, landing=landing_frame(spark, sf_dir, SPECS[n], "lineitem"))
                  for n in _SIDE])
    stored = None
    for n in _SIDE:
        rows = lake.report(SPECS[n]).groupBy(F.lit(f"[{SPECS[n].name}]").alias("job")).agg(F.count("*").alias("stored"))
        stored = rows if stored is None else stored.unionByName(rows)
    log = spark.table(lake.fq("silver", reports.RUN_LOG)).select(
        F.col("NombreJob").alias("job"), F.col("EstadoEjecucion").alias("status"), F.col("FilasInsertadas").alias("inserted"))
    return log.join(stored, "job", "left").withColumn("stored", F.coalesce("stored", F.lit(0)))


@register("parallel_same_window", f"{_MONTH_SQL}, 4 AS logged FROM {_MONTH_ORDERS}")
def parallel_same_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads of one window at once: each stores it whole, one after the other."""
    lake, landing = scratch_lake(spark), td.orders_landing(spark, sf_dir)
    lake.ensure_report_table(_SPEC)
    side_by_side([lambda: reports.load(spark, lake, _SPEC, DAY, landing=landing) for _ in range(4)])
    good = spark.table(lake.fq("silver", reports.RUN_LOG)).where("EstadoEjecucion = 'Exitoso'").agg(F.count("*").cast("int").alias("logged"))
    return reports.deliver(spark, lake, _SPEC, DAY).crossJoin(F.broadcast(good))


@register("parallel_quarantine", f"""
SELECT '[901_ORDERS]' AS job, CAST(date_trunc('{{}}', o_orderdate) AS DATE) AS window_start, count(*) AS n
FROM orders WHERE 1 = 0 GROUP BY 2""".replace("'{}'", "'month'") + "".join(f"""
UNION ALL SELECT '[90{i}_ORDERS]', DATE '{window_for(DAY, f).start}', count(*) FROM orders
WHERE {sql_window('o_orderdate', window_for(DAY, f).start, window_for(DAY, f).end)} HAVING count(*) > 0"""
                                                             for i, f in enumerate((DAILY, WEEKLY, MONTHLY, QUARTERLY), 1)))
def parallel_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: four loads at once whose rows all break the layout; the quarantine has them all."""
    lake = scratch_lake(spark)
    bad = td.orders_landing(spark, sf_dir).withColumn("o_totalprice", F.lit(1e12))
    specs = [td.orders_spec(f).with_version(name=f"90{i}_ORDERS") for i, f in enumerate((DAILY, WEEKLY, MONTHLY, QUARTERLY), 1)]
    side_by_side([lambda s=s: reports.load(spark, lake, s, DAY, landing=bad) for s in specs])
    return spark.table(lake.fq("silver", "quarantine")).groupBy("job", "window_start").agg(F.count("*").alias("n"))


@register("parallel_ingest", ORACLE["ingest_crash_retry"])
def parallel_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ingests of the same files at once: rows and rejects land once."""
    lake, folder = scratch_lake(spark), unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    lake.ensure_landing_table(ORDERS_INGEST)
    results = side_by_side([lambda: ingest(spark, lake, ORDERS_INGEST, _routed(spark, folder)) for _ in range(3)])
    if sorted(r.accepted > 0 for r in results) != [False, False, True] and sum(len(r.files) for r in results) == 0:
        raise RuntimeError("no ingest landed the files")
    row = F.from_json("row", "o_orderkey decimal(18,0), o_custkey decimal(18,0), o_orderstatus string, "
                             "o_totalprice decimal(12,2), o_orderdate date")
    rejects = spark.table(lake.fq("bronze", "rejects")).select(row.alias("r")).select("r.*", F.lit("rejected").alias("o_orderpriority"))
    return spark.table(lake.fq("bronze", ORDERS_INGEST.landing_table)).select(*_LANDED).unionByName(rejects)


@register("ingest_crash_staged", ORACLE["ingest_roundtrip"])
def ingest_crash_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch breaks off before its rows are complete, the next one while it moves
    them; the third lands each file once."""
    from periodica.sources import ingest as g
    lake, folder = scratch_lake(spark), unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    for step in ("publishing", "_move_accepted"):
        with broken(g, step):
            g.ingest(spark, lake, ORDERS_INGEST, _routed(spark, folder))
    g.ingest(spark, lake, ORDERS_INGEST, _routed(spark, folder))
    return spark.table(lake.fq("bronze", ORDERS_INGEST.landing_table)).select(*_LANDED)


@register("run_log_compacted", f"""
SELECT job, count(*) AS n FROM (VALUES ('[901_ORDERS]'), ('[901_ORDERS]'), ('[901_ORDERS]'), ('[902_LINEITEM]')) AS t(job),
       (SELECT count(*) AS rows FROM {_MONTH_ORDERS}) o WHERE o.rows > 0 GROUP BY job""")
def run_log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's small folders merged into one; runs after the merge are added as before."""
    from periodica.sources.appends import compact_runs
    lake, landing = loaded(spark, sf_dir)
    reports.load(spark, lake, _SPEC, dt.date(1995, 4, 1), landing=landing)
    log = lake.fq("silver", reports.RUN_LOG)
    if compact_runs(spark, log) != 2:
        raise RuntimeError("two runs were to be merged")
    reports.load(spark, lake, _SPEC, DAY, landing=landing)
    reports.load(spark, lake, td.lineitem_spec(MONTHLY), DAY, landing=td.lineitem_landing(spark, sf_dir))
    return spark.table(log).groupBy(F.col("NombreJob").alias("job")).agg(F.count("*").alias("n"))


_TEXT_SQL = f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM {_MONTH_ORDERS} AND o_orderkey % 10 <> 0"


@register("load_bad_dates", _TEXT_SQL)
def load_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a control text that is no date is in no window, for a load as for a backfill."""
    lake = scratch_lake(spark)
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("no date")).otherwise(F.to_date("o_orderdate").cast("string"))
    res = reports.load(spark, lake, _SPEC, DAY, landing=td.orders_landing(spark, sf_dir).withColumn("o_orderdate", text))
    if not res.ok:
        raise RuntimeError(res.message)
    return lake.report(_SPEC).select("o_orderkey", "o_orderdate")

"""Benchmark of the headline jobs on the shared test tables.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
(default 8) and prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Timed jobs (lineitem is the wide landing table, l_shipdate its control date):

* ``backfill_monthly``   initial load of every monthly window (one job, staged,
                         quality-gated, dynamic overwrite of checked windows)
* ``load_month``         one monthly window load (S14) of the same table
* ``rerun_month``        the same load again; row equality is checked untimed
* ``deliver_monthly`` / ``deliver_weekly`` / ``deliver_daily``
                         deliveries of one window (partition-pruned read,
                         formatted projection), materialised with the noop sink
* ``quality_scan``       V1 + V2 over every lineitem column, one pass
* ``migrate_rewrite``    rename + drop + widen of the stored table, rewrite + swap
* ``ingest_extract``     pipe-delimited lineitem extract -> typed landing
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from periodica.session import build_session
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage and task times for tools/stage_times.py (off unless asked for)
        os.makedirs(os.environ["BENCH_EVENT_LOG_DIR"], exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          extra=extra)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="periodica-bench-"))

    from pyspark.sql import functions as F

    from periodica.functions.periods import DAILY, MONTHLY, WEEKLY
    from periodica.operators import migrate as mg
    from periodica.operators.quality import quality_scan
    from periodica.plans import reports
    from periodica.plans import testdata as td
    from periodica.plans.registry import scratch_lake
    from periodica.session import unique_path
    from periodica.sources.ingest import ingest
    from periodica.spec import IngestSpec

    day = dt.date(1997, 6, 15)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # untimed warm-up on the smallest tables (JVM class loading, codegen caches)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        wl = scratch_lake(spark)
        reports.backfill(spark, wl, td.orders_spec(MONTHLY), td.orders_landing(spark, warm_dir))
        reports.load(spark, wl, td.orders_spec(MONTHLY), day, landing=td.orders_landing(spark, warm_dir))

    lake = scratch_lake(spark)
    spec = td.lineitem_spec(MONTHLY)
    landing = td.lineitem_landing(spark, sf_dir)
    n_rows = landing.count()

    results = timed("backfill_monthly", lambda: reports.backfill(spark, lake, spec, landing))
    assert all(r.ok for r in results), [r.message for r in results if not r.ok][:1]
    first = timed("load_month", lambda: reports.load(spark, lake, spec, day, landing=landing))
    assert first.ok

    table = lake.report_table(spec)

    def window_rows():  # one window, for the equality check outside the timer
        return sorted(map(tuple, spark.table(table).where(F.col("period_start") == F.lit(first.window.start))
                          .drop("FECHA_EXTRACCION").collect()))
    snap = window_rows()
    assert timed("rerun_month", lambda: reports.load(spark, lake, spec, day, landing=landing)).ok
    assert snap == window_rows()

    timed("deliver_monthly", lambda: noop(reports.deliver(spark, lake, spec, day)))
    # weekly and daily deliveries from tables stored by week and by day (one
    # quarter of the rows; untimed), each checked to have the rows it should
    from periodica.functions.periods import in_window, window_for
    around = window_for(day, "quarterly")
    for freq in (WEEKLY, DAILY):
        other = scratch_lake(spark)
        fspec, w = td.lineitem_spec(freq), window_for(day, freq)
        reports.backfill(spark, other, fspec, landing, first=around.start, last=around.end)
        due = landing.where(in_window("l_shipdate", w)).count()
        assert due and reports.deliver(spark, other, fspec, day).count() == due
        timed(f"deliver_{freq}", lambda: noop(reports.deliver(spark, other, fspec, day)))

    strict = td.lineitem_spec(MONTHLY, strict=True)
    timed("quality_scan", lambda: quality_scan(td.table(spark, sf_dir, "lineitem"), strict.columns).collect())

    steps = (mg.Rename("l_returnflag", "L_RETURNFLAG"), mg.Drop(("l_tax",)),
             mg.Retype("l_linenumber", "numeric(12,0)"), mg.Retype("l_quantity", "numeric(15,2)"))
    out = timed("migrate_rewrite", lambda: mg.migrate_table(spark, table, steps, keys=["ID"]))
    assert out["status"] == "Exitoso", out

    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    folder = unique_path(spark, "drop")
    li = td.table(spark, sf_dir, "lineitem")
    (li.select(*[F.date_format(F.col(c), "yyyy/MM/dd").alias(c) if c == "l_shipdate"
                 else F.col(c).cast("string").alias(c) for c in cols])
     .write.option("header", True).option("sep", "|").option("quote", "\u0000").csv(folder))
    ing = IngestSpec(
        name="LINEITEM_EXTRACT", file_pattern=r"^part-.*\.csv$", landing="LMDA.LINEITEM",
        column_map=tuple((c, c) for c in cols), date_fields=("l_shipdate",),
        numeric_fields=tuple((c, "numeric(12,2)") for c in
                             ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]) +
        tuple((c, "numeric(18,0)") for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]),
        text_fields=(("l_returnflag", 1), ("l_linestatus", 1)), control_col="l_shipdate",
        final_columns=("ID", *cols, "FECHA_EXTRACCION"))
    from periodica.sources.files import list_files, route
    paths = route(list_files(spark, folder), [ing]).where(F.col("spec").isNotNull())
    res = timed("ingest_extract", lambda: ingest(spark, lake, ing, paths))
    assert res.accepted == n_rows, (res.accepted, n_rows)

    # the bench's own scratch tables and extract (created above) are removed
    from periodica.session import delete_path
    for t in list(spark.catalog.listTables(lake.db("silver"))) + list(spark.catalog.listTables(lake.db("bronze"))):
        spark.sql(f"DROP TABLE IF EXISTS {t.database}.{t.name}")
    delete_path(spark, lake.root)
    delete_path(spark, folder)

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "lineitem_rows": n_rows,
                      "ingest_rows_per_sec": round(n_rows / times["ingest_extract"], 1),
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

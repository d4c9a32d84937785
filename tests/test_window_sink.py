"""S14 / A2 properties: idempotent, other windows untouched, empty source
empties, violations leave the window untouched and go to quarantine."""
import datetime as dt

from pyspark.sql import functions as F

from periodica.functions.periods import MONTHLY, window_for
from periodica.operators.runlog import alert_rows, log_rows
from periodica.plans import reports
from periodica.plans import testdata as td

SF = "/root/testdata/sf0.001"
DAY = dt.date(1995, 3, 15)


def _snapshot(spark, lake, spec):
    return sorted(tuple(r) for r in spark.table(lake.report_table(spec))
                  .drop("FECHA_EXTRACCION").collect())


def test_load_properties(spark, lake):
    spec = td.orders_spec(MONTHLY)
    landing = td.orders_landing(spark, SF)
    full = reports.backfill(spark, lake, spec, landing)
    assert all(r.ok for r in full)
    total = spark.table(lake.report_table(spec)).count()
    assert total == landing.count()
    before = _snapshot(spark, lake, spec)
    once = reports.load(spark, lake, spec, DAY, landing=landing)
    assert once.ok and once.deleted == once.inserted
    assert _snapshot(spark, lake, spec) == before           # re-load = same table
    w = window_for(DAY, MONTHLY)
    delivered = reports.deliver(spark, lake, spec, DAY).count()
    assert delivered == once.inserted                        # inserted == delivered
    empty = reports.load(spark, lake, spec, DAY, landing=landing.where(F.lit(False)))
    assert empty.ok and empty.inserted == 0 and empty.deleted == once.inserted
    assert spark.table(lake.report_table(spec)).count() == total - once.inserted
    other = spark.table(lake.report_table(spec)).where(F.col("period_start") != F.lit(w.start))
    assert other.count() == total - once.inserted            # other windows untouched


def test_violations_leave_window_untouched(spark, lake):
    spec = td.lineitem_spec(MONTHLY)
    strict = td.lineitem_spec(MONTHLY, strict=True).with_version(name=spec.name)
    landing = td.lineitem_landing(spark, SF)
    ok = reports.load(spark, lake, spec, DAY, landing=landing)
    assert ok.ok and ok.inserted > 0
    bad_landing = landing.withColumn("l_extendedprice", F.col("l_extendedprice") + 200000)
    res = reports.load(spark, lake, strict, DAY, landing=bad_landing)
    assert not res.ok and res.rejected == ok.inserted and res.inserted == 0
    assert reports.deliver(spark, lake, spec, DAY).count() == ok.inserted
    q = spark.table(lake.fq("silver", "quarantine"))
    assert q.count() == res.rejected
    assert q.first()["reason"] == "l_extendedprice:numeric(7,2)"
    log = log_rows(spark, [ok, res])
    alerts = alert_rows(log, "ops@example.org", "perfil").collect()
    assert len(alerts) == 1 and alerts[0]["subject"] == "ALERTA: Error en [902_LINEITEM]"
    assert "segundos" in alerts[0]["body"] and "Programado por: No especificado" in alerts[0]["body"]
    assert alert_rows(log, None, "perfil").count() == 0     # no recipients -> no alert


def test_guards_and_regressions(spark, lake):
    """a NULL control date never matches; F7: EXISTS guard; F10: the legacy
    impossible range is always empty; X8: a delivery depends on its date."""
    from periodica.functions.periods import Window, in_window
    from periodica.sources.tables import window_has_rows
    df = spark.createDataFrame([(dt.date(1995, 3, 1),), (None,)], "d date")
    w = window_for(DAY, MONTHLY)
    assert df.where(in_window("d", w)).count() == 1
    assert window_has_rows(df.where(in_window("d", w)))
    same = Window(MONTHLY, DAY, DAY)
    assert not window_has_rows(df.where(in_window("d", same)))
    spec = td.orders_spec(MONTHLY)
    reports.backfill(spark, lake, spec, td.orders_landing(spark, SF))
    a = {r[0] for r in reports.deliver(spark, lake, spec, DAY).select("o_orderkey").collect()}
    b = {r[0] for r in reports.deliver(spark, lake, spec, dt.date(1995, 4, 15)).select("o_orderkey").collect()}
    assert a and b and not a & b


def test_versions_and_self_refresh(spark, lake):
    """One folder per window version, the version before the last is removed, and a
    self-select refresh reads the old folder while writing the new one."""
    import os
    from periodica.sources.versions import partition_location
    spec = td.orders_spec(MONTHLY)
    landing = td.orders_landing(spark, SF)
    assert reports.load(spark, lake, spec, DAY, landing=landing).ok
    t = lake.report_table(spec)
    first = partition_location(spark, t, window_for(DAY, MONTHLY).start)
    assert "/_versions/period_start=1995-03-01/" in first
    n = spark.table(t).count()
    again = reports.load(spark, lake, spec, DAY, landing=landing)
    second = partition_location(spark, t, window_for(DAY, MONTHLY).start)
    # the folder that open readers may still list stays until the next load
    assert again.ok and second != first and os.path.exists(first.replace("file:", ""))
    assert reports.load(spark, lake, spec, DAY, landing=landing).ok
    assert not os.path.exists(first.replace("file:", "")) and os.path.exists(second.replace("file:", ""))
    assert spark.table(t).count() == n
    selfspec = spec.with_version(source="self", inject="run_day", inject_col="o_orderdate")
    res = reports.self_refresh(spark, lake, selfspec, DAY)
    assert res.ok and res.inserted == n
    got = {r[0] for r in spark.table(t).select("o_orderdate").collect()}
    assert got == {DAY}


def test_written_delivery_file(spark, lake):
    """Pipe-delimited text with the layout header; NULL as an empty cell."""
    import glob
    from periodica.operators.deliver import write_delivery
    from periodica.session import unique_path
    spec = td.orders_spec(MONTHLY)
    reports.load(spark, lake, spec, DAY, landing=td.orders_landing(spark, SF))
    out = reports.deliver(spark, lake, spec, DAY)
    path = unique_path(spark, "delivery")
    write_delivery(out, path)
    files = sorted(glob.glob(path.replace("file:", "") + "/part-*.csv"))
    lines = [ln.rstrip("\n") for f in files for ln in open(f, encoding="utf-8")]
    assert lines[0] == "|".join(c.header for c in spec.columns)
    body = [ln for ln in lines if ln != lines[0]]
    assert len(body) == out.count() and all(ln.count("|") == 5 for ln in body)
    assert all(ln.split("|")[4][4] == "/" for ln in body)  # yyyy/MM/dd


def test_backfill_empties_windows_of_its_range(spark, lake):
    """A second backfill over a narrower source empties the window left without rows."""
    spec = td.orders_spec(MONTHLY)
    landing = td.orders_landing(spark, SF)
    first = reports.backfill(spark, lake, spec, landing)
    t = lake.report_table(spec)
    assert all(r.ok for r in first) and spark.table(t).count() == landing.count()
    march = window_for(DAY, MONTHLY)
    narrowed = landing.where(~((F.col("o_orderdate") >= F.lit(march.start)) & (F.col("o_orderdate") < F.lit(march.end))))
    again = reports.backfill(spark, lake, spec, narrowed, first=dt.date(1995, 1, 1), last=dt.date(1995, 12, 31))
    by_start = {r.window.start: r for r in again}
    assert by_start[march.start].inserted == 0 and by_start[march.start].deleted > 0
    assert spark.table(t).count() == narrowed.count()
    assert spark.table(t).where(F.col("period_start") == F.lit(march.start)).count() == 0


def test_large_window_is_written_by_several_tasks(spark, lake):
    """A window that one month of rows fills is not sorted and written by one task."""
    spec = td.orders_spec(MONTHLY)
    n = 600_000
    rows = spark.range(0, n, 1, 8).select(
        F.col("id").alias("o_orderkey"), F.xxhash64("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (F.col("id") % 1000 / 8).alias("o_totalprice"), F.lit(DAY).alias("o_orderdate"),
        F.substring(F.md5(F.col("id").cast("string")), 1, 15).alias("o_orderpriority"),
        F.sha2(F.col("id").cast("string"), 256).alias("ID"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("FECHA_EXTRACCION"))
    done = reports.backfill(spark, lake, spec, rows)
    assert [r.inserted for r in done] == [n]
    files = spark.table(lake.report_table(spec)).groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and sum(r["count"] for r in files) == n

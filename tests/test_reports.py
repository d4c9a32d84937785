"""Fixture replays: each of the 23 report shapes goes through file -> landing ->
report table -> delivery (landing-sourced reports) or seed -> self refresh ->
delivery (self-select reports), with rows in three windows."""
import dataclasses
import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from fixtures import file_name, value, windows
from periodica.functions.periods import window_for
from periodica.layouts import INGEST, SPECS
from periodica.plans import reports
from periodica.session import unique_path
from periodica.sources.files import list_files, route, write_xlsx
from periodica.sources.ingest import ingest
from periodica.spec import LOAD_TS_COL

RUN_DAY = dt.date(2026, 6, 17)
NOW = dt.datetime(2026, 6, 17, 9, 30, 40)
LANDING = sorted(INGEST)
SELF = sorted(n for n, s in SPECS.items() if s.source == "self")
FMT_RE = {"yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$", "dd/MM/yyyy": r"^\d{2}/\d{2}/\d{4}$",
          "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$"}


def _write_source(spark, numero, rows):
    ing = INGEST[numero]
    folder = unique_path(spark, "drop")
    os.makedirs(folder.replace("file:", ""), exist_ok=True)
    name = file_name(ing.file_pattern)
    path = os.path.join(folder, name)
    headers = [src for src, _ in ing.column_map]
    if ing.file_type == "excel":
        with open(path, "wb") as fh:
            fh.write(write_xlsx([headers] + [[r[h] for h in headers] for r in rows]))
    else:
        with open(path, "w", encoding="utf-8") as fh:
            fh.write("|".join(headers) + "\n")
            for r in rows:
                fh.write("|".join(r[h] for h in headers) + "\n")
    return folder, path


def _rows(numero, n=12):
    spec, ing = SPECS[numero], INGEST[numero]
    starts = windows(RUN_DAY, spec.frequency)
    renames = {stored: land for land, stored in spec.load_renames}
    by_land = {renames.get(c.name, c.name): c for c in spec.stored_columns}
    rows = []
    for i in range(n):
        r = {}
        for src, land in ing.column_map:
            col = by_land[land]
            r[src] = value(col, i, RUN_DAY)
            if land == renames.get(spec.control, spec.control):
                r[src] = starts[i % 3].strftime("%Y/%m/%d")
        rows.append(r)
    return rows


@pytest.mark.parametrize("numero", LANDING)
def test_landing_report_replay(spark, lake, numero):
    spec, ing = SPECS[numero], INGEST[numero]

    rows = _rows(numero)
    folder, path = _write_source(spark, numero, rows)
    routed = route(list_files(spark, folder), INGEST.values()).collect()
    assert [r["spec"] for r in routed] == [ing.name] and routed[0]["n_matches"] == 1  # S1
    res = ingest(spark, lake, ing, [r["path"] for r in routed], run_date=RUN_DAY, now=NOW)
    assert (res.accepted, res.rejected, res.bad_files) == (len(rows), 0, {})
    again = ingest(spark, lake, ing, [r["path"] for r in routed], run_date=RUN_DAY, now=NOW)
    assert again.accepted == 0 and again.skipped  # S10: a file lands once

    day = NOW.date() if spec.control == LOAD_TS_COL else RUN_DAY
    run = reports.load(spark, lake, spec, day)
    assert run.ok, run.message
    if spec.control == LOAD_TS_COL or ing.control_from == "run_date":
        expected = len(rows)  # the whole batch sits in the run's window
    else:
        expected = sum(1 for i in range(len(rows)) if i % 3 == 0)
    assert run.inserted == expected
    out = reports.deliver(spark, lake, spec, day)
    assert out.columns == [c.header for c in spec.columns]  # layout order, case-exact
    got = out.collect()
    assert len(got) == expected
    for c in spec.columns:
        if c.fmt:
            assert all(r[c.header] is None or re.match(FMT_RE[c.fmt], r[c.header]) for r in got)
    # other windows untouched by a second load; the same load twice = once
    rerun = reports.load(spark, lake, spec, day)
    assert rerun.deleted == expected and rerun.inserted == expected
    assert reports.deliver(spark, lake, spec, day).count() == expected


@pytest.mark.parametrize("numero", SELF)
def test_self_select_replay(spark, lake, numero):
    spec = SPECS[numero]
    starts = windows(RUN_DAY, spec.frequency)
    rows = []
    for i in range(9):
        r = {c.name: value(c, i, RUN_DAY, iso=True) for c in spec.stored_columns}
        r[spec.control] = starts[i % 3].isoformat()
        rows.append(r)
    df = spark.createDataFrame(rows)
    assert reports.seed(spark, lake, spec, df) == 9
    w = window_for(RUN_DAY, spec.frequency)
    day = w.start
    res = reports.self_refresh(spark, lake, spec, day)
    assert res.ok and res.inserted == 3 and res.deleted == 3  # fix of X1: the window survives
    table = spark.table(lake.report_table(spec))
    assert table.count() == 9
    if spec.inject_col:
        vals = {r[0] for r in table.where(F.col("period_start") == F.lit(w.start))
                .select(spec.inject_col).collect()}
        assert vals == {day}  # X6: injected run day
    out = reports.deliver(spark, lake, spec, day)
    assert out.count() == 3 and out.columns == [c.header for c in spec.columns]
    if spec.sort:
        keys = [tuple(r[k] for k in spec.sort) for r in out.collect()]
        assert keys == sorted(keys)


def test_self_select_literal_defect(spark, lake):
    """X1 (negative test): deleting the window before selecting from it, as the
    legacy procedure does, leaves the window empty."""
    spec = SPECS[212]
    rows = [{c.name: value(c, i, RUN_DAY, iso=True) for c in spec.stored_columns} for i in range(4)]
    for r in rows:
        r["FECHA_INFO"] = RUN_DAY.isoformat()
    reports.seed(spark, lake, spec, spark.createDataFrame(rows))
    w = window_for(RUN_DAY, spec.frequency)
    t = lake.report_table(spec)
    spark.sql(f"ALTER TABLE {t} DROP PARTITION (period_start = DATE'{w.start}')")  # DELETE
    snap = spark.table(t).where(F.col("period_start") == F.lit(w.start))  # INSERT ... SELECT same window
    assert snap.count() == 0


def test_prev_version_changes_only_the_control(spark, lake):
    from periodica.layouts import report
    prev = report(21, "prev")
    assert prev.control == "FE_CON_OPE" and prev.columns == SPECS[21].columns

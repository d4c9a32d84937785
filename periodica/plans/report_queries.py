"""The 23 reports' own load and delivery operators (L*, D*) registered over the
shared test tables.

Each report's landing (or stored table, for self-select reports) is derived
from a whole test table by one rule per declared type, written once as SQL
text: Spark evaluates it with ``F.expr`` to build the landing rows the real
``load`` / ``self_refresh`` / ``deliver`` jobs consume, and the DuckDB oracle
evaluates the same text. Landing-sourced reports derive from ``lineitem``
(control dates from ``l_shipdate``); self-select reports from ``events``
(dates from ``ts``, spread over two months).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import DAILY, window_for
from periodica.layouts import PREVIOUS, SPECS, report, report_142_versions
from periodica.plans import reports
from periodica.plans import testdata as td
from periodica.plans.registry import _DUCK_FMT, register, scratch_lake
from periodica.spec import ID_COL, LOAD_TS_COL, LayoutColumn, ReportSpec

LINE_DAY = dt.date(1995, 3, 15)
EVENT_DAY = dt.date(2024, 1, 10)

SOURCES = {
    "lineitem": dict(date="CAST(l_shipdate AS DATE)", key="l_partkey",
                     text="l_returnflag || l_linestatus", wide="l_extendedprice",
                     mid="l_quantity", small="l_linenumber", frac="l_discount",
                     id="CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"),
    # events fall into one month; every other user's are a month later
    "events": dict(date="(CAST(ts AS DATE) + CAST((user_id % 2) * 31 AS INT))", key="user_id", text="event_type", wide="value",
                   mid="length(event_type)", small="length(event_type)", frac="value / 1000",
                   id="CAST(event_id AS STRING)"),
}


def source_expr(col: LayoutColumn, src: str, at: int) -> str:
    """SQL text of the value that the ``at``-th stored column takes from the source
    table. By construction it fits the declared type, and columns of one type
    differ from each other, so that a load that swaps two of them, or windows on
    the wrong one, delivers other rows than the oracle."""
    s = SOURCES[src]
    t = col.type
    if t.kind == "date":
        return f"({s['date']} + {at})"
    if t.kind == "varchar":
        return f"right(repeat('0', {t.length}) || CAST({s['key']} + {at} AS STRING), {t.length})"
    if t.kind == "text":
        return f"{s['text']} || '{at}'"
    if t.kind == "numeric":
        whole = t.precision - t.scale
        if src == "events":
            return f"({s['wide']} + {at})" if whole >= 4 else (f"({s['mid']} + {at % 2})" if whole >= 1 else s["frac"])
        if whole >= 6:
            return f"({s['wide']} + {at})"
        if whole >= 2:
            return f"({s['mid']} + {at % 49})"
        return f"({s['small']} + {at % 3})" if whole == 1 else s["frac"]
    raise ValueError(t)


def stored_expr(spec: ReportSpec, name: str, src: str) -> str:
    at = next(i for i, c in enumerate(spec.stored_columns) if c.name == name)
    return source_expr(spec.stored_columns[at], src, at)


def _landing_name(spec: ReportSpec, name: str) -> str:
    for land, stored in spec.load_renames:
        if stored == name:
            return land
    return name


def landing_frame(spark: SparkSession, sf_dir: str, spec: ReportSpec, src: str) -> DataFrame:
    """Landing rows of ``spec`` derived from a whole test table."""
    df = td.table(spark, sf_dir, src)
    cols = [F.expr(stored_expr(spec, c.name, src)).alias(_landing_name(spec, c.name))
            for c in spec.stored_columns if c.name != LOAD_TS_COL]
    load_ts = F.expr(f"CAST({SOURCES[src]['date']} AS TIMESTAMP)").cast("timestamp_ntz")
    return df.select(F.expr(SOURCES[src]["id"]).alias(ID_COL), *cols, load_ts.alias(LOAD_TS_COL))


def oracle(spec: ReportSpec, src: str, day: dt.date) -> str:
    """DuckDB SQL of the delivered window, from the same derivation rule."""
    w = window_for(day, spec.frequency)
    out = []
    for c in spec.columns:
        e = stored_expr(spec, c.name, src)
        if c.name == spec.inject_col and spec.inject == "run_day":
            e = f"DATE '{day}'"
        elif c.name == spec.inject_col and spec.inject == "period_start":
            e = f"DATE '{w.start}'"
        if c.fmt:
            e = f"strftime(CAST({e} AS DATE), '{_DUCK_FMT[c.fmt]}')"
        elif c.type.kind == "numeric":
            e = f"CAST({e} AS DECIMAL({c.type.precision},{c.type.scale}))"
        out.append(f"{e} AS {c.header}")
    control = (f"CAST({SOURCES[src]['date']} AS TIMESTAMP)" if spec.control == LOAD_TS_COL
               else stored_expr(spec, spec.control, src))
    order = f" ORDER BY {', '.join(stored_expr(spec, k, src) for k in spec.sort)}" \
        if spec.sort else ""
    return (f"SELECT {', '.join(out)} FROM {src} "
            f"WHERE {control} >= DATE '{w.start}' AND {control} < DATE '{w.end}'{order}")


def _register(numero: int, spec: ReportSpec | None = None, suffix: str = "") -> None:
    spec = spec or SPECS[numero]
    src, day = ("events", EVENT_DAY) if spec.source == "self" else ("lineitem", LINE_DAY)
    if src == "events" and spec.frequency == DAILY and spec.control != LOAD_TS_COL:
        # a day that the control column has: its dates are those of the events, shifted by its place
        day += dt.timedelta(days=next(i for i, c in enumerate(spec.stored_columns) if c.name == spec.control))

    @register(f"report_{numero:03d}{suffix}", oracle(spec, src, day))
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = scratch_lake(spark)
        landing = landing_frame(spark, sf_dir, spec, src)
        if spec.source == "self":
            # the stored table as it stands before the run: every window of the source
            seeded = reports.backfill(spark, lake, spec.with_version(source="landing", inject="none"), landing)
            if not all(r.ok for r in seeded):
                raise RuntimeError(seeded[0].message)
            res = reports.self_refresh(spark, lake, spec, day)
        else:
            res = reports.load(spark, lake, spec, day, landing=landing)
        if not res.ok:
            raise RuntimeError(res.message)
        return reports.deliver(spark, lake, spec, day)
    q.__doc__ = (f"L{numero:03d} + D{numero:03d}: {spec.name}, {spec.frequency} on {spec.control}"
                 f" ({'self-select refresh' if spec.source == 'self' else 'landing load'}), "
                 f"then the delivery of the window of {day}.")


for _n in sorted(SPECS):
    _register(_n)
# earlier versions kept by the rollback scripts (§2.M) and the two older 142 deliveries
for _n in sorted(PREVIOUS):
    if not report(_n, "prev").delete_on:
        _register(_n, report(_n, "prev"), "_prev")
_v142 = report_142_versions()
_register(142, _v142["weekly_ymd"], "_weekly_ymd")
_register(142, _v142["monthly_ymd"], "_monthly_ymd")



@register("report_212_ref_213", f"""
SELECT k AS ID_LINEA, count(*) AS n_rows FROM (
  SELECT {stored_expr(SPECS[212], "ID_LINEA", "events")} AS k FROM events) c
WHERE k NOT IN (SELECT {stored_expr(SPECS[213], "ID_LINEA", "events")} FROM events)
GROUP BY k""")
def report_212_ref_213(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of report 212 must exist in report 213 (both stored
    from the whole events table)."""
    lake = scratch_lake(spark)
    for n in (212, 213):
        spec = SPECS[n]
        res = reports.backfill(spark, lake, spec.with_version(source="landing"),
                               landing_frame(spark, sf_dir, spec, "events"))
        if not all(r.ok for r in res):
            raise RuntimeError(res[0].message)
    return reports.referential_violations(spark, lake, 212)


_PREV133, _DAY133 = report(133, "prev"), dt.date(2024, 2, 12)
_STORED133 = ", ".join(f"CAST({stored_expr(_PREV133, c.name, 'events')} AS DECIMAL({c.type.precision},{c.type.scale})) AS {c.name}"
                       if c.type.kind == "numeric" else f"{stored_expr(_PREV133, c.name, 'events')} AS {c.name}"
                       for c in _PREV133.columns)


@register("report_133_prev", f"""
SELECT {_STORED133} FROM events WHERE {stored_expr(_PREV133, 'FECHAINFO', 'events')} = DATE '{_DAY133}'
UNION ALL SELECT * FROM (SELECT {_STORED133} FROM events) s
WHERE FE_CON_OPE <> DATE '{_DAY133}'""")
def report_133_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier 133: a daily load that deletes by FE_CON_OPE and inserts by FECHAINFO.
    Rows of the day's FE_CON_OPE go from whatever window holds them, and what the day's
    window held of other days stays beside the rows that are added (whole table)."""
    lake = scratch_lake(spark)
    landing = landing_frame(spark, sf_dir, _PREV133, "events")
    first = reports.backfill(spark, lake, _PREV133, landing)
    run = reports.load(spark, lake, _PREV133, _DAY133, landing=landing)
    if not all(r.ok for r in [*first, run]):
        raise RuntimeError(run.message)
    return lake.report(_PREV133).select(*[c.name for c in _PREV133.columns])


_PREV132, _OLD132, _NEW132 = report(132, "prev"), dt.date(2024, 2, 5), dt.date(2024, 2, 6)


def _layout_sql(spec: ReportSpec, day: dt.date, names: list[str]) -> str:
    have = {c.name: c for c in spec.columns}
    out = []
    for n in names:
        e = stored_expr(spec, n, "events") if n in have else "NULL"
        if n == spec.inject_col:
            e = f"DATE '{day}'"
        c = have.get(n) or next(x for x in SPECS[132].columns + _PREV132.columns if x.name == n)
        out.append(f"CAST({e} AS {dict(numeric=f'DECIMAL({c.type.precision},{c.type.scale})', date='DATE').get(c.type.kind, 'VARCHAR')}) AS {n}")
    return f"SELECT {', '.join(out)} FROM events WHERE {stored_expr(spec, spec.control, 'events')} = DATE '{day}'"


_NAMES132 = [c.name for c in SPECS[132].columns] + [c.name for c in _PREV132.columns[18:]]


@register("report_132_two_layouts", f"{_layout_sql(_PREV132, _OLD132, _NAMES132)} UNION ALL "
                                    f"{_layout_sql(SPECS[132].with_version(inject_col=None), _NEW132, _NAMES132)}")
def report_132_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window loaded under the layout with FE_CORTE, one under the layout that dropped
    it, in one table that was not rewritten: each is read under its own layout."""
    lake, out = scratch_lake(spark), None
    for spec, day in ((_PREV132, _OLD132), (SPECS[132], _NEW132)):
        if lake.exists(lake.report_table(spec)):
            lake.relayout(spec)
        res = reports.load(spark, lake, spec.with_version(source="landing", inject="none"), day,
                           landing=landing_frame(spark, sf_dir, spec, "events"))
        if not res.ok:
            raise RuntimeError(res.message)
    for spec, day in ((_PREV132, _OLD132), (SPECS[132], _NEW132)):
        rows = lake.window_as(spec, window_for(day, DAILY)).select(*[c.name for c in spec.columns])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select(*_NAMES132)


_PAIR_KEY = "CAST(event_id % 397 AS STRING)"     # some keys twice in a day, most once or never
_PAIR_DAY = dt.date(2024, 1, 22)


@register("report_155_with_156", f"""
WITH a AS (SELECT {_PAIR_KEY} AS NU_ID FROM events
           WHERE {stored_expr(SPECS[155], "FE_CON_OPE", "events")} = DATE '{_PAIR_DAY}'),
     b AS (SELECT {_PAIR_KEY} AS NU_ID FROM events
           WHERE {stored_expr(SPECS[156], "FECHA", "events")} = DATE '{_PAIR_DAY}'),
     n AS (SELECT NU_ID, count(*) AS n_left FROM a GROUP BY 1), m AS (SELECT NU_ID, count(*) AS n_right FROM b GROUP BY 1)
SELECT NU_ID, n_left, n_right, CASE WHEN n_left > 1 AND n_right > 1 THEN 0 ELSE n_left * n_right END AS joined
FROM n JOIN m USING (NU_ID)""")
def report_155_with_156(spark: SparkSession, sf_dir: str) -> DataFrame:
    """155 with 156 by NU_ID, both stored from the whole events table, which repeats
    keys: a key that both repeat is reported, any other joined."""
    lake, day = scratch_lake(spark), _PAIR_DAY
    for n in (155, 156):
        keyed = landing_frame(spark, sf_dir, SPECS[n], "events").drop("NU_ID").join(
            td.table(spark, sf_dir, "events").select(F.expr(SOURCES["events"]["id"]).alias(ID_COL), F.expr(_PAIR_KEY).alias("NU_ID")), ID_COL)
        res = reports.backfill(spark, lake, SPECS[n].with_version(source="landing"), keyed)
        if not all(r.ok for r in res):
            raise RuntimeError(res[0].message)
    joined = reports.companion_rows(spark, lake, 155, day).groupBy("NU_ID").agg(F.count("*").alias("joined"))
    sizes = [lake.report(SPECS[n]).where(F.col(SPECS[n].control) == F.lit(day)).groupBy("NU_ID").agg(F.count("*").alias(c))
             for n, c in ((155, "n_left"), (156, "n_right"))]
    unclear = reports.companion_unclear(spark, lake, 155, day).withColumn("joined", F.lit(0).cast("long"))
    clear = sizes[0].join(sizes[1], "NU_ID").join(joined, "NU_ID")
    return clear.unionByName(unclear.select(*clear.columns))

"""Registered queries over the shared test tables and their DuckDB oracles.

Every query reads whole test tables (or tables Spark derived from them) and
runs the engine's real operators: loads write report tables into a scratch lake
under the shared folder, deliveries read them back by partition. Each entry of
``QUERIES`` has an SQL twin in ``ORACLE`` with identical column names.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.formats import DMY_SLASH, YMD_DASH, YMD_SLASH, render_date
from periodica.functions.periods import (DAILY, MONTHLY, QUARTERLY, WEEKLY, period_end,
                                         period_start, weekday_offset_start, window_for)
from periodica.functions.scalar import zero_pad
from periodica.plans import reports
from periodica.plans import testdata as td
from periodica.session import unique_path
from periodica.sources.tables import Lake
from periodica.spec import ReportSpec

DAY = dt.date(1995, 3, 15)          # run date of the order loads
EVENT_DAY = dt.date(2024, 1, 10)    # run date of the load-time report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def scratch_lake(spark: SparkSession) -> Lake:
    """A fresh lake (own folder, own schema names) under the shared folder."""
    tag = uuid.uuid4().hex[:10]
    return Lake(spark, root=unique_path(spark, "lake"), prefix=f"q{tag}_")


# -- SQL helpers for the oracles -------------------------------------------
_DUCK_FMT = {YMD_SLASH: "%Y/%m/%d", DMY_SLASH: "%d/%m/%Y", YMD_DASH: "%Y-%m-%d"}


def _sql_type(t) -> str:
    return {"numeric": f"DECIMAL({t.precision},{t.scale})", "bigint": "BIGINT",
            "int": "INTEGER", "date": "DATE", "varchar": "VARCHAR", "text": "VARCHAR",
            "timestamp": "TIMESTAMP", "bit": "BOOLEAN"}[t.kind]


def sql_delivery_cols(spec: ReportSpec, literals: dict[str, str] | None = None) -> str:
    """Delivered columns as DuckDB SQL; ``literals`` replaces a column by a
    fixed SQL value (an injected date)."""
    literals = literals or {}
    out = []
    for c in spec.columns:
        e = f"CAST({c.name} AS {_sql_type(c.type)})"
        if c.fmt:
            e = f"strftime(CAST({c.name} AS DATE), '{_DUCK_FMT[c.fmt]}')"
        e = literals.get(c.name, e)
        out.append(f"{e} AS {c.header}")
    return ", ".join(out)


def sql_window(col: str, start: dt.date, end: dt.date) -> str:
    return f"{col} >= DATE '{start}' AND {col} < DATE '{end}'"


# -- deliveries (P1-P4, F1, F2, X-1, S12, S14, S19) --------------------------
def _load_and_deliver(spark: SparkSession, landing: DataFrame, spec: ReportSpec,
                      day: dt.date) -> DataFrame:
    lake = scratch_lake(spark)
    res = reports.load(spark, lake, spec, day, landing=landing)
    if not res.ok:
        raise RuntimeError(res.message)
    return reports.deliver(spark, lake, spec, day)


def _orders_delivery(freq: str):
    spec = td.orders_spec(freq)
    w = window_for(DAY, freq)
    sql = f"SELECT {sql_delivery_cols(spec)} FROM orders WHERE {sql_window('o_orderdate', w.start, w.end)}"

    @register(f"deliver_{freq}", sql)
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _load_and_deliver(spark, td.orders_landing(spark, sf_dir), spec, DAY)
    return q


for _f in (DAILY, WEEKLY, MONTHLY, QUARTERLY):
    _orders_delivery(_f)


_LI = td.lineitem_spec(MONTHLY)
_LIW = window_for(DAY, MONTHLY)


@register("deliver_lineitem_monthly",
          f"SELECT {sql_delivery_cols(_LI)} FROM lineitem "
          f"WHERE {sql_window('l_shipdate', _LIW.start, _LIW.end)}")
def deliver_lineitem_monthly(spark, sf_dir):
    return _load_and_deliver(spark, td.lineitem_landing(spark, sf_dir), _LI, DAY)


_EV = td.events_spec()
_EVW = window_for(EVENT_DAY, WEEKLY)


@register("deliver_by_load_ts", f"""
SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS value
FROM events
WHERE date_trunc('minute', ts + INTERVAL 30 SECOND) >= TIMESTAMP '{_EVW.start} 00:00:00'
  AND date_trunc('minute', ts + INTERVAL 30 SECOND) < TIMESTAMP '{_EVW.end} 00:00:00'""")
def deliver_by_load_ts(spark, sf_dir):
    """P5: the window is on the landing load time (rounded to the minute),
    which is carried through to the report table and never delivered."""
    return _load_and_deliver(spark, td.events_landing(spark, sf_dir), _EV, EVENT_DAY)


@register("window_bounds", """
SELECT d AS day,
       CAST(date_trunc('week', d) AS DATE) AS week_start,
       CAST(date_trunc('week', d) + INTERVAL 7 DAY AS DATE) AS week_end,
       CAST(date_trunc('month', d) AS DATE) AS month_start,
       CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS month_end,
       CAST(date_trunc('quarter', d) AS DATE) AS quarter_start,
       CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) AS quarter_end,
       CAST(d - CAST(((dayofweek(d) + 1 + 5) % 7) AS INTEGER) AS DATE) AS week_start_ref
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) t""")
def window_bounds(spark, sf_dir):
    """P1-P4 bounds for every distinct order date, plus the legacy procedures' own
    weekday formula, which must equal the Monday start."""
    d = td.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return d.select(
        "day",
        period_start("day", WEEKLY).alias("week_start"), period_end("day", WEEKLY).alias("week_end"),
        period_start("day", MONTHLY).alias("month_start"), period_end("day", MONTHLY).alias("month_end"),
        period_start("day", QUARTERLY).alias("quarter_start"),
        period_end("day", QUARTERLY).alias("quarter_end"),
        weekday_offset_start("day").alias("week_start_ref"))


@register("date_formats", """
SELECT o_orderkey,
       strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d') AS ymd_slash,
       strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS dmy_slash,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS ymd_dash
FROM orders""")
def date_formats(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", render_date(d, YMD_SLASH).alias("ymd_slash"),
                    render_date(d, DMY_SLASH).alias("dmy_slash"),
                    render_date(d, YMD_DASH).alias("ymd_dash"))


@register("zero_pad", """
SELECT c_custkey,
       right(repeat('0', 6) || CAST(c_custkey AS VARCHAR), 6) AS custkey_6,
       right(repeat('0', 3) || CAST(c_custkey AS VARCHAR), 3) AS custkey_3,
       right(repeat('0', 3) || CAST(c_nationkey AS VARCHAR), 3) AS nationkey_3
FROM customer""")
def zero_pad_query(spark, sf_dir):
    """X-5 / V9: keys of 4+ digits keep their right end at width 3."""
    c = td.table(spark, sf_dir, "customer")
    return c.select("c_custkey", zero_pad("c_custkey", 6).alias("custkey_6"),
                    zero_pad("c_custkey", 3).alias("custkey_3"),
                    zero_pad("c_nationkey", 3).alias("nationkey_3"))


# -- window replacement (S14, A2, X1, X6) ------------------------------------
_OM = td.orders_spec(MONTHLY)
_MW = window_for(DAY, MONTHLY)
_ORDER_COLS_SQL = ("o_orderkey, o_custkey, o_orderstatus, CAST({p} AS DECIMAL(12,2)) AS o_totalprice, "
                   "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority")
_OUTSIDE_SQL = (f"SELECT {_ORDER_COLS_SQL.format(p='o_totalprice')}, "
                f"CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start FROM orders "
                f"WHERE NOT ({sql_window('o_orderdate', _MW.start, _MW.end)})")
_STORED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
           "o_orderpriority", "period_start"]


def _orders_table(spark: SparkSession, sf_dir: str, freq: str = MONTHLY):
    """Initial load of every window of ``orders`` into a fresh report table."""
    lake = scratch_lake(spark)
    spec = td.orders_spec(freq)
    results = reports.backfill(spark, lake, spec, td.orders_landing(spark, sf_dir))
    failed = [r for r in results if not r.ok]
    if failed:
        raise RuntimeError(failed[0].message)
    return lake, spec, results


def _corrected_march(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A late correction of March 1995: only its ``F`` orders, price + 1."""
    o = td.orders_landing(spark, sf_dir)
    return (o.where(F.col("o_orderstatus") == "F")
            .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))


@register("replace_window", f"""
{_OUTSIDE_SQL}
UNION ALL
SELECT {_ORDER_COLS_SQL.format(p='o_totalprice + 1.0')}, DATE '{_MW.start}' AS period_start
FROM orders WHERE {sql_window('o_orderdate', _MW.start, _MW.end)} AND o_orderstatus = 'F'""")
def replace_window_query(spark, sf_dir):
    """The March window is replaced by its correction; every other window
    keeps its rows."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    res = reports.load(spark, lake, spec, DAY, landing=_corrected_march(spark, sf_dir))
    if not res.ok:
        raise RuntimeError(res.message)
    return spark.table(lake.report_table(spec)).select(*_STORED)


@register("replace_window_rerun", ORACLE["replace_window"])
def replace_window_rerun(spark, sf_dir):
    """Loading the same window twice gives the same table as loading it once."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    for _ in range(2):
        res = reports.load(spark, lake, spec, DAY, landing=_corrected_march(spark, sf_dir))
        if not res.ok:
            raise RuntimeError(res.message)
    return spark.table(lake.report_table(spec)).select(*_STORED)


@register("replace_window_empty", _OUTSIDE_SQL)
def replace_window_empty(spark, sf_dir):
    """An empty source empties exactly its window."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    empty = td.orders_landing(spark, sf_dir).where(F.lit(False))
    res = reports.load(spark, lake, spec, DAY, landing=empty)
    if not res.ok or res.inserted != 0:
        raise RuntimeError(res.message)
    return spark.table(lake.report_table(spec)).select(*_STORED)


@register("self_refresh", f"""
{_OUTSIDE_SQL}
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       DATE '{DAY}' AS o_orderdate, o_orderpriority, DATE '{_MW.start}' AS period_start
FROM orders WHERE {sql_window('o_orderdate', _MW.start, _MW.end)}""")
def self_refresh_query(spark, sf_dir):
    """Self-select load (fix of X1): the window is rebuilt from a snapshot of
    itself, with the run day injected into the date (X6)."""
    lake, spec, _ = _orders_table(spark, sf_dir)
    selfspec = spec.with_version(source="self", inject="run_day", inject_col="o_orderdate")
    res = reports.self_refresh(spark, lake, selfspec, DAY)
    if not res.ok:
        raise RuntimeError(res.message)
    return spark.table(lake.report_table(spec)).select(*_STORED)


@register("run_log", f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start,
       count(*) AS inserted, count(*) AS deleted, 'Exitoso' AS status,
       'Registros eliminados: ' || count(*) || chr(13) || chr(10) ||
       'Proceso completado. Filas totales: ' || count(*) || chr(13) || chr(10) AS details,
       '[901_ORDERS]' AS job
FROM orders GROUP BY 1""")
def run_log(spark, sf_dir):
    """The log of a second full load; every window reports the rows
    it deleted (the first load's) and inserted."""
    from periodica.operators.runlog import log_rows
    lake, spec, _ = _orders_table(spark, sf_dir)
    again = reports.backfill(spark, lake, spec, td.orders_landing(spark, sf_dir))
    return log_rows(spark, again).select(
        F.col("InicioVentana").alias("window_start"),
        F.col("FilasInsertadas").cast("long").alias("inserted"),
        F.lit(None).cast("long").alias("deleted"),
        F.col("EstadoEjecucion").alias("status"), F.col("DetallesLog").alias("details"),
        F.col("NombreJob").alias("job")).join(
        spark.createDataFrame([(r.window.start, r.deleted) for r in again],
                              "window_start date, deleted_n long"), "window_start"
    ).withColumn("deleted", F.col("deleted_n")).drop("deleted_n")


_LS = td.lineitem_spec(MONTHLY, strict=True)


def _misfit_sql(spec: ReportSpec) -> str:
    from periodica.functions.types import sql_misfit
    parts = []
    for c in spec.stored_columns:
        if not c.nullable:
            parts.append(f"{c.name} IS NULL")
        if c.type.kind != "text":
            parts.append(sql_misfit(c.name, c.type))
    return " OR ".join(parts)


@register("alert_rows", f"""
SELECT 'ALERTA: Error en [902_LINEITEM_STRICT]' AS subject,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS window_start,
       CAST(count(*) AS VARCHAR) || ' filas no cumplen el layout; ventana sin cambios' AS error
FROM lineitem WHERE {_misfit_sql(_LS)} GROUP BY 2""")
def alert_rows_query(spark, sf_dir):
    """A full load under a layout that some prices do not fit; each
    window with such rows fails (left untouched, rows quarantined) and gets an
    alert; windows without them load."""
    from periodica.operators.runlog import alert_rows, log_rows
    lake = scratch_lake(spark)
    results = reports.backfill(spark, lake, _LS, td.lineitem_landing(spark, sf_dir))
    log = log_rows(spark, results)
    return alert_rows(log, "ops@example.org", "default").select("subject", "window_start", "error")


# -- report index (S16-S18) --------------------------------------------------
# The index is derived from scaling tables: one entry per supplier, and a batch
# of changes from the customers (their keys overlap the suppliers' keys, so the
# upsert both updates and inserts).
_INDEX_SQL = ("SELECT CAST(s_suppkey AS INTEGER) AS numero, s_name AS nombre, 'Mensual' AS frecuencia, "
              "s_acctbal >= 0 AS activo, CAST(NULL AS VARCHAR) AS nombre_archivo FROM supplier")
_CHANGES_SQL = ("SELECT CAST(c_custkey AS INTEGER) AS numero, c_name AS nombre, 'Semanal' AS frecuencia, "
                "FALSE AS activo, c_mktsegment || '.txt' AS nombre_archivo FROM customer")
_UPDATE_KEY = 7


def _index(spark, sf_dir):
    s = td.table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("int").alias("numero"), F.col("s_name").alias("nombre"),
                    F.lit("Mensual").alias("frecuencia"), (F.col("s_acctbal") >= 0).alias("activo"),
                    F.lit(None).cast("string").alias("nombre_archivo"))


def _changes(spark, sf_dir):
    c = td.table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("numero"), F.col("c_name").alias("nombre"),
                    F.lit("Semanal").alias("frecuencia"), F.lit(False).alias("activo"),
                    F.concat(F.col("c_mktsegment"), F.lit(".txt")).alias("nombre_archivo"))


@register("index_upsert", f"""
WITH i AS ({_INDEX_SQL}), c AS ({_CHANGES_SQL})
SELECT CASE WHEN c.numero IS NOT NULL THEN c.numero ELSE i.numero END AS numero,
       CASE WHEN c.numero IS NOT NULL THEN c.nombre ELSE i.nombre END AS nombre,
       CASE WHEN c.numero IS NOT NULL THEN c.frecuencia ELSE i.frecuencia END AS frecuencia,
       CASE WHEN c.numero IS NOT NULL THEN c.activo ELSE i.activo END AS activo,
       CASE WHEN c.numero IS NOT NULL THEN c.nombre_archivo ELSE i.nombre_archivo END AS nombre_archivo
FROM i FULL JOIN c ON i.numero = c.numero""")
def index_upsert_query(spark, sf_dir):
    """Full outer join on ``numero``; changed entries take every new field."""
    from periodica.operators.index import index_upsert
    return index_upsert(_index(spark, sf_dir), _changes(spark, sf_dir))


@register("index_update", f"""
WITH i AS ({_INDEX_SQL})
SELECT numero, nombre,
       CASE WHEN numero = {_UPDATE_KEY} AND frecuencia IS DISTINCT FROM 'Trimestral' THEN 'Trimestral' ELSE frecuencia END AS frecuencia,
       activo, nombre_archivo,
       (numero = {_UPDATE_KEY} AND frecuencia IS DISTINCT FROM 'Trimestral') AS changed
FROM i""")
def index_update_query(spark, sf_dir):
    """Update only where different; ``changed`` counts the affected rows."""
    from periodica.operators.index import index_update
    new, _ = index_update(_index(spark, sf_dir), _UPDATE_KEY, "frecuencia", "Trimestral")
    return new.withColumnRenamed("_changed", "changed")


@register("index_delete", f"WITH i AS ({_INDEX_SQL}) SELECT * FROM i WHERE numero <> {_UPDATE_KEY}")
def index_delete_query(spark, sf_dir):
    """Delete one entry by number."""
    from periodica.operators.index import index_delete
    return index_delete(_index(spark, sf_dir), _UPDATE_KEY)


# -- joins and catalogs (J1, J3, J4, J5, V7, V8) ----------------------------
@register("catalog_presence", """
SELECT r.k AS nationkey, CASE WHEN n.n_nationkey IS NULL THEN 'FALTA' ELSE 'OK' END AS status
FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) r
LEFT JOIN nation n ON r.k = n.n_nationkey""")
def catalog_presence(spark, sf_dir):
    """Every nation key the customer and supplier tables use, OK / FALTA."""
    from periodica.operators.joins import presence
    req = (td.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
           .union(td.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey")))
           .distinct())
    ex = td.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"))
    return presence(req, ex, "nationkey")


# Fixed catalogs of the checks below (allowed values).
CATALOGS = {
    "prioridad": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"],
    "bandera": ["A", "R"],
    "estatus": ["O", "F"],
}


def _catalog(spark, name: str) -> DataFrame:
    return spark.createDataFrame([(name, k) for k in CATALOGS[name]], "catalog string, key string")


def _violations(spark, sf_dir) -> DataFrame:
    from periodica.operators.joins import catalog_violations
    o = td.table(spark, sf_dir, "orders")
    li = td.table(spark, sf_dir, "lineitem")
    return (catalog_violations(o, "o_orderpriority", _catalog(spark, "prioridad"), "901_ORDERS")
            .unionByName(catalog_violations(li, "l_returnflag", _catalog(spark, "bandera"), "902_LINEITEM"))
            .unionByName(catalog_violations(li, "l_linestatus", _catalog(spark, "estatus"), "902_LINEITEM"))
            .withColumnRenamed("column", "field"))


def _in_list(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


_VIOL_SQL = f"""
SELECT '901_ORDERS' AS report, 'o_orderpriority' AS field, o_orderpriority AS value, count(*) AS n_rows
FROM orders WHERE o_orderpriority NOT IN ({_in_list(CATALOGS['prioridad'])}) GROUP BY 3
UNION ALL
SELECT '902_LINEITEM', 'l_returnflag', l_returnflag, count(*) FROM lineitem
WHERE l_returnflag NOT IN ({_in_list(CATALOGS['bandera'])}) GROUP BY 3
UNION ALL
SELECT '902_LINEITEM', 'l_linestatus', l_linestatus, count(*) FROM lineitem
WHERE l_linestatus NOT IN ({_in_list(CATALOGS['estatus'])}) GROUP BY 3"""


@register("catalog_violations", _VIOL_SQL)
def catalog_violations_query(spark, sf_dir):
    """Values outside their catalog, counted per value."""
    return _violations(spark, sf_dir)


@register("violation_summary", f"""
SELECT report, field, sum(n_rows) AS n_rows, count(*) AS n_values,
       min(value) AS min_value, max(value) AS max_value
FROM ({_VIOL_SQL}) v GROUP BY report, field""")
def violation_summary_query(spark, sf_dir):
    from periodica.operators.joins import violation_summary
    return violation_summary(_violations(spark, sf_dir).withColumnRenamed("field", "column")) \
        .withColumnRenamed("column", "field")


@register("referential_violations", """
SELECT o_orderkey, count(*) AS n_rows FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
GROUP BY o_orderkey""")
def referential_violations(spark, sf_dir):
    """Orders with no lineitem (the child report must have its parent)."""
    from periodica.operators.joins import orphan_keys
    return orphan_keys(td.table(spark, sf_dir, "orders"), "o_orderkey",
                       td.table(spark, sf_dir, "lineitem"), "l_orderkey")


@register("referential_valid", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def referential_valid(spark, sf_dir):
    """Customers that have orders (left semi join)."""
    from periodica.operators.joins import valid_rows
    c = td.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return valid_rows(c, "c_custkey", td.table(spark, sf_dir, "orders"), "o_custkey")


@register("companion_join", f"""
SELECT o.o_orderkey, strftime(CAST(o.o_orderdate AS DATE), '%Y/%m/%d') AS o_orderdate,
       l.l_linenumber, l.l_quantity, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE {sql_window('o.o_orderdate', _MW.start, _MW.end)}""")
def companion_join(spark, sf_dir):
    """The window's orders with their companion lineitem rows."""
    from periodica.operators.joins import companion
    o = td.table(spark, sf_dir, "orders")
    o = o.where((F.col("o_orderdate") >= F.lit(_MW.start)) & (F.col("o_orderdate") < F.lit(_MW.end)))
    li = td.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    j = companion(o.select("o_orderkey", "o_orderdate"),
                  li.select("o_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["o_orderkey"])
    return j.select("o_orderkey", render_date(F.to_date("o_orderdate"), YMD_SLASH).alias("o_orderdate"),
                    "l_linenumber", "l_quantity", "l_extendedprice")


# -- quality (V1, V2) --------------------------------------------------------
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("null_report", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in _LI_COLS) + " FROM lineitem")
def null_report(spark, sf_dir):
    from periodica.operators.quality import null_counts
    return null_counts(td.table(spark, sf_dir, "lineitem"), _LI_COLS)


def _scan_sql(table: str, spec_cols) -> str:
    from periodica.functions.types import sql_misfit
    parts = []
    for c in spec_cols:
        if not c.nullable:
            parts.append(f"SELECT '{c.name}' AS field, 'null' AS rule, "
                         f"count(*) FILTER (WHERE {c.name} IS NULL) AS n_rows FROM {table}")
        if c.type.kind != "text":
            parts.append(f"SELECT '{c.name}', '{c.type.sql_name}', "
                         f"count(*) FILTER (WHERE {sql_misfit(c.name, c.type)}) FROM {table}")
    return "\nUNION ALL\n".join(parts)


@register("quality_scan", _scan_sql("lineitem", _LS.columns))
def quality_scan_query(spark, sf_dir):
    """V1 + V2 over every lineitem column in one pass (strict layout)."""
    from periodica.operators.quality import quality_scan
    return quality_scan(td.table(spark, sf_dir, "lineitem"), _LS.columns)


from periodica.spec import parse_layout  # noqa: E402

PART_LAYOUT = parse_layout("p_partkey bigint | p_name varchar(10) | p_brand varchar(8) | "
                           "p_type varchar(6) | p_size numeric(2,0) | p_retailprice numeric(6,2)")


@register("type_violations", _scan_sql("part", PART_LAYOUT))
def type_violations(spark, sf_dir):
    """V2: text longer than declared, numbers over the declared precision."""
    from periodica.operators.quality import quality_scan
    return quality_scan(td.table(spark, sf_dir, "part"), PART_LAYOUT)


# -- migration (E1-E15, E19) ------------------------------------------------
from periodica.operators import migrate as mg  # noqa: E402
from periodica.sources.tables import SILVER  # noqa: E402

CUSTOMER_STEPS = (
    mg.Rename("c_name", "C_NOMBRE"),                 # E4
    mg.Drop(("c_mktsegment",)),                      # E8
    mg.Retype("c_nationkey", "numeric(12,0)"),       # E9 widen int -> numeric(12,0)
    mg.AddColumn("FECHA_ALTA", "date"),              # E1 nullable
    mg.AddColumn("CANAL", "varchar(3)", ""),         # E2 marker default
    mg.Backfill("c_acctbal", 0),                     # E11
)
PART_STEPS = (
    mg.Rename("p_name", "P_NAME"),                   # E5 case only
    mg.Truncate("p_brand", 5),                       # E13 narrow with LEFT
    mg.Retype("p_size", "varchar(6)"),               # E10 int -> text
    mg.Retype("p_retailprice", "numeric(8,2)"),      # E9
)


def _copy_to_lake(spark, lake: Lake, df: DataFrame, name: str) -> str:
    fq = lake.fq(SILVER, name)
    df.write.option("path", lake.location(SILVER, name)).saveAsTable(fq)
    return fq


_MIG_CUSTOMER_SQL = """
SELECT c_custkey, c_name AS C_NOMBRE, CAST(c_nationkey AS DECIMAL(12,0)) AS c_nationkey,
       COALESCE(c_acctbal, 0) AS c_acctbal, CAST(NULL AS DATE) AS FECHA_ALTA, '' AS CANAL
FROM customer"""


@register("migrate_customer", _MIG_CUSTOMER_SQL)
def migrate_customer(spark, sf_dir):
    """E1/E2/E4/E8/E9/E11 as one rewrite of a stored table, then a swap."""
    lake = scratch_lake(spark)
    fq = _copy_to_lake(spark, lake, td.table(spark, sf_dir, "customer"), "customer_rep")
    out = mg.migrate_table(spark, fq, CUSTOMER_STEPS, keys=["c_custkey"])
    if out["status"] != "Exitoso":
        raise RuntimeError(out)
    return spark.table(out["table"])


@register("migrate_twice", _MIG_CUSTOMER_SQL)
def migrate_twice(spark, sf_dir):
    """Running the same migration again changes nothing (every step checks
    the current schema first)."""
    lake = scratch_lake(spark)
    fq = _copy_to_lake(spark, lake, td.table(spark, sf_dir, "customer"), "customer_rep")
    for _ in range(2):
        out = mg.migrate_table(spark, fq, CUSTOMER_STEPS, keys=["c_custkey"])
        if out["status"] != "Exitoso":
            raise RuntimeError(out)
    return spark.table(fq)


@register("migrate_part", """
SELECT p_partkey, p_name AS P_NAME, left(p_brand, 5) AS p_brand, p_type,
       CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS DECIMAL(8,2)) AS p_retailprice
FROM part""")
def migrate_part(spark, sf_dir):
    """Case-only rename, narrowing with LEFT, kind change."""
    return mg.migrate(td.table(spark, sf_dir, "part"), PART_STEPS)


@register("migrate_truncated", """
SELECT p_partkey, 'p_brand' AS field, p_brand AS value FROM part WHERE length(p_brand) > 5""")
def migrate_truncated(spark, sf_dir):
    """Rows whose text the narrowing cuts, reported before the swap."""
    return mg.truncated_rows(td.table(spark, sf_dir, "part"), PART_STEPS, ["p_partkey"])


@register("migrate_rejects", """
SELECT c_custkey, 'c_acctbal' AS field, CAST(c_acctbal AS VARCHAR) AS value
FROM customer WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NULL""")
def migrate_rejects(spark, sf_dir):
    """A lossy type change lists the values it cannot keep (and
    ``migrate_table`` refuses to swap)."""
    steps = (mg.Retype("c_acctbal", "numeric(5,2)"),)
    return mg.migration_rejects(td.table(spark, sf_dir, "customer"), steps, ["c_custkey"])


# -- frequency (P6, P7), versions (§2.M), order (A4) -----------------------
@register("frequency_change", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, count(*) AS n_rows
FROM orders GROUP BY 1""")
def frequency_change(spark, sf_dir):
    """A weekly report becomes monthly; every stored row moves to its
    month partition in one rewrite."""
    from periodica.operators.frequency import change_frequency
    lake, spec, _ = _orders_table(spark, sf_dir, WEEKLY)
    fq = lake.report_table(spec)
    change_frequency(spark, fq, spec, MONTHLY)
    return spark.table(fq).groupBy("period_start").agg(F.count(F.lit(1)).alias("n_rows"))


@register("window_drift", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start,
       count(*) AS loaded, count(*) AS delivered, 0 AS drift
FROM orders GROUP BY 1""")
def window_drift_query(spark, sf_dir):
    """Rows loaded by a weekly table, counted per month, against the rows
    a monthly table delivers per month."""
    from periodica.operators.frequency import rows_per_period, window_drift
    wl, wspec, _ = _orders_table(spark, sf_dir, WEEKLY)
    ml, mspec, _ = _orders_table(spark, sf_dir, MONTHLY)
    loaded = rows_per_period(spark.table(wl.report_table(wspec)), "o_orderdate", MONTHLY)
    delivered = (spark.table(ml.report_table(mspec)).groupBy("period_start")
                 .agg(F.count(F.lit(1)).alias("n_rows")))
    return window_drift(loaded, delivered)


_PREV = td.lineitem_spec(WEEKLY, inject="period_start", inject_col="l_shipdate", version="prev")
_PW = window_for(DAY, WEEKLY)


def _prev_cols_sql() -> str:
    return sql_delivery_cols(_PREV, {"l_shipdate": f"'{_PW.start.strftime('%Y/%m/%d')}'"})


@register("prev_version_deliver", f"""
SELECT {_prev_cols_sql()} FROM lineitem
WHERE {sql_window('l_shipdate', _PW.start, _PW.end)}""")
def prev_version_deliver(spark, sf_dir):
    """§2.M: the earlier version of a report (weekly, every row dated with the
    period start) from the same generic load/deliver operator."""
    return _load_and_deliver(spark, td.lineitem_landing(spark, sf_dir), _PREV, DAY)


_SORTED = td.orders_spec(MONTHLY, sort=("o_orderdate", "o_orderkey"))


@register("sorted_delivery", f"""
SELECT {sql_delivery_cols(_SORTED)} FROM orders
WHERE {sql_window('o_orderdate', _MW.start, _MW.end)}
ORDER BY o_orderdate, o_orderkey""")
def sorted_delivery(spark, sf_dir):
    """A4: deliveries with a declared order (212, 213) sort by two keys."""
    return _load_and_deliver(spark, td.orders_landing(spark, sf_dir), _SORTED, DAY)


# -- ingestion (S1-S10) and the landing stream ------------------------------
from periodica.spec import IngestSpec  # noqa: E402

ORDERS_INGEST = IngestSpec(
    name="ORDERS_EXTRACT", file_pattern=r"^part-.*\.csv$", landing="LMDA.ORDERS",
    column_map=tuple((c, c) for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                      "o_orderdate", "o_orderpriority"]),
    date_fields=("o_orderdate",),
    numeric_fields=(("o_orderkey", "numeric(18,0)"), ("o_custkey", "numeric(18,0)"),
                    ("o_totalprice", "numeric(12,2)")),
    text_fields=(("o_orderstatus", 1), ("o_orderpriority", 15)),
    allow_empty=False, control_col="o_orderdate",
    final_columns=("ID", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority", "FECHA_EXTRACCION"),
    file_type="csv", delimiter="|")
_LANDED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def write_extract(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Pipe-delimited extract of ``orders`` as a source system would send it:
    three date forms (by order status) and the lowest priority left empty."""
    o = td.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    date_txt = (F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy/MM/dd"))
                .when(F.col("o_orderstatus") == "O", F.date_format(d, "dd/MM/yyyy"))
                .otherwise(F.date_format(d, "yyyy-MM-dd")))
    prio = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority"))
    (o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
              F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus",
              F.col("o_totalprice").cast("string").alias("o_totalprice"),
              date_txt.alias("o_orderdate"), prio.alias("o_orderpriority"))
     .write.option("header", True).option("sep", "|").option("emptyValue", "")
     .option("quote", "\u0000").csv(folder))


def _routed(spark, folder: str) -> DataFrame:
    """The files that belong to this source and to no other."""
    from periodica.layouts import INGEST
    from periodica.sources.files import list_files, route
    r = route(list_files(spark, folder), [ORDERS_INGEST, *INGEST.values()])
    return r.where((F.col("spec") == ORDERS_INGEST.name) & (F.col("n_matches") == 1))


_INGEST_SQL = """
SELECT CAST(o_orderkey AS DECIMAL(18,0)) AS o_orderkey, CAST(o_custkey AS DECIMAL(18,0)) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority <> '5-LOW'"""


def _ingest(spark, sf_dir, times: int = 1):
    from periodica.sources.ingest import ingest
    lake = scratch_lake(spark)
    folder = unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    paths = _routed(spark, folder)
    for _ in range(times):
        ingest(spark, lake, ORDERS_INGEST, paths)
    return lake


@register("ingest_roundtrip", _INGEST_SQL)
def ingest_roundtrip(spark, sf_dir):
    """Route by name, read by header, convert three date forms and the
    numbers, reject rows with an empty cell (allow_empty = false)."""
    lake = _ingest(spark, sf_dir)
    return spark.table(lake.fq("bronze", ORDERS_INGEST.landing_table)).select(*_LANDED)


@register("ingest_append_once", _INGEST_SQL)
def ingest_append_once(spark, sf_dir):
    """The same files offered twice land once."""
    lake = _ingest(spark, sf_dir, times=2)
    return spark.table(lake.fq("bronze", ORDERS_INGEST.landing_table)).select(*_LANDED)


@register("ingest_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'o_orderpriority:empty' AS reason
FROM orders WHERE o_orderpriority = '5-LOW'""")
def ingest_rejects(spark, sf_dir):
    """Rejected rows with their reason, kept in the rejects table."""
    lake = _ingest(spark, sf_dir)
    rej = spark.table(lake.fq("bronze", "rejects"))
    return rej.select(F.get_json_object("row", "$.o_orderkey").alias("o_orderkey"),
                      F.col("_reason").alias("reason"))


@register("stream_landing", _INGEST_SQL)
def stream_landing(spark, sf_dir):
    """Structured Streaming form of the landing: the drop folder drained with
    Trigger.AvailableNow, each micro-batch converted and split like a batch."""
    from periodica.streaming.landing_stream import land_stream
    lake = scratch_lake(spark)
    folder = unique_path(spark, "drop")
    write_extract(spark, sf_dir, folder)
    land_stream(spark, lake, ORDERS_INGEST, folder,
                checkpoint=unique_path(spark, "stream-ckpt"))
    return spark.table(lake.fq("bronze", ORDERS_INGEST.landing_table)).select(*_LANDED)


# -- delivered file (S19), T-SQL length and seconds (F9, X-13, X-20) --------
@register("delivery_file", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice,
       strftime(CAST(o_orderdate AS DATE), '%Y/%m/%d') AS o_orderdate, o_orderpriority
FROM orders WHERE {sql_window('o_orderdate', _MW.start, _MW.end)}""")
def delivery_file(spark, sf_dir):
    """The delivered window written as a pipe-delimited file with a header
    and read back as text, exactly as the regulator receives it."""
    from periodica.operators.deliver import write_delivery
    out = _load_and_deliver(spark, td.orders_landing(spark, sf_dir), _OM, DAY)
    path = unique_path(spark, "delivery")
    write_delivery(out, path)
    names = out.columns
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("sep", "|").csv(path)


@register("len_predicate", """
SELECT p_partkey, p_name, length(rtrim(p_name)) AS name_len, left(p_name, 5) AS name_5
FROM part WHERE length(rtrim(p_name)) > 10""")
def len_predicate(spark, sf_dir):
    """F9 / X-19 / X-20: LEN ignores trailing blanks; LEFT keeps the start."""
    from periodica.functions.scalar import tsql_left, tsql_len
    p = td.table(spark, sf_dir, "part")
    return (p.where(tsql_len("p_name") > 10)
            .select("p_partkey", "p_name", tsql_len("p_name").alias("name_len"),
                    tsql_left("p_name", 5).alias("name_5")))


@register("seconds_to_load", """
SELECT event_id,
       CAST(epoch(date_trunc('second', date_trunc('minute', ts + INTERVAL 30 SECOND)))
            - epoch(date_trunc('second', ts)) AS BIGINT) AS seconds
FROM events""")
def seconds_to_load(spark, sf_dir):
    """X-13 with S13: second boundaries between an event and its load time
    rounded to the minute (between -30 and 30)."""
    from periodica.functions.scalar import seconds_between
    e = td.events_landing(spark, sf_dir)
    return e.select("event_id", seconds_between("ts", "FECHA_EXTRACCION").alias("seconds"))


@register("landing_coverage", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS window_start, count(*) AS n_rows,
       CAST(date_trunc('month', l_shipdate) AS DATE) IS NULL AS null_control
FROM lineitem GROUP BY 1""")
def landing_coverage_query(spark, sf_dir):
    """landing rows per monthly window, NULL control dates in their own bucket."""
    from periodica.operators.quality import landing_coverage
    return landing_coverage(td.lineitem_landing(spark, sf_dir), td.lineitem_spec(MONTHLY))

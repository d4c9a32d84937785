"""Registered queries of the order, digest, accumulation, migration and schema
operators: whole tables in, the operators' own results out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import MONTHLY, window_for
from periodica.layouts import INGEST, SPECS
from periodica.operators import migrate as mg
from periodica.operators import quality as ql
from periodica.plans import reports
from periodica.plans import testdata as td
from periodica.plans.registry import _orders_table, register, scratch_lake
from periodica.plans.report_queries import landing_frame, stored_expr
from periodica.session import unique_path
from periodica.sources.tables import SILVER
from periodica.spec import ID_COL, LOAD_TS_COL, parse_layout

ORDERS = td.orders_spec(MONTHLY)


# -- P6: what was loaded against what is delivered, by content ---------------
_CHANGED = "o_orderkey % 50 = 0 AND month(o_orderdate) % 3 = 0"     # delivered with another amount
_MISSING = "o_orderkey % 50 = 0 AND month(o_orderdate) % 3 = 1"     # not delivered


@register("window_content_drift", f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, count(*) AS loaded,
       count(*) FILTER (WHERE NOT ({_MISSING})) AS delivered, count(*) FILTER (WHERE {_MISSING}) AS drift,
       count(*) FILTER (WHERE ({_MISSING}) OR ({_CHANGED})) = 0 AS same_rows
FROM orders GROUP BY 1""")
def window_content_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that lost rows, months with as many rows of other content, and months
    that agree."""
    from periodica.operators.frequency import period_digest, window_drift
    landing = td.orders_landing(spark, sf_dir)
    sides = []
    for rows in (landing, landing.where(f"NOT ({_MISSING})").withColumn(
            "o_totalprice", F.when(F.expr(_CHANGED), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))):
        lake = scratch_lake(spark)
        reports.backfill(spark, lake, ORDERS, rows)
        sides.append(period_digest(lake.report(ORDERS), "o_orderdate", MONTHLY, [c.name for c in ORDERS.columns]))
    return window_drift(*sides)


# -- A4: the order of delivered files ----------------------------------------
def _ordered(numero: int) -> None:
    spec = SPECS[numero]
    day = dt.date(2024, 1, 10)
    w = window_for(day, spec.frequency)
    by = {c.name: c for c in spec.columns}
    keys = [f"strftime(CAST({stored_expr(spec, k, 'events')} AS DATE), '%Y/%m/%d')" if by[k].fmt
            else f"CAST({stored_expr(spec, k, 'events')} AS VARCHAR)" for k in spec.sort]
    order = ", ".join(f"{stored_expr(spec, k, 'events')} NULLS FIRST" for k in spec.sort)
    control = stored_expr(spec, spec.control, "events")

    @register(f"delivery_order_{numero}", f"""
SELECT row_number() OVER (ORDER BY {order}) AS line, {', '.join(f'{e} AS {k}' for e, k in zip(keys, spec.sort))}
FROM events WHERE {control} >= DATE '{w.start}' AND {control} < DATE '{w.end}'""")
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from periodica.operators.deliver import delivered_lines, write_delivery
        lake, path = scratch_lake(spark), unique_path(spark, "delivery")
        rows = landing_frame(spark, sf_dir, spec, "events")
        reports.backfill(spark, lake, spec.with_version(source="landing"), rows)
        write_delivery(reports.deliver(spark, lake, spec, day), path)
        names = [c.header for c in spec.columns]
        cells = F.split("value", r"\|", -1)
        return delivered_lines(spark, path).select("line", *[cells[names.index(by[k].header)].alias(k) for k in spec.sort])
    q.__doc__ = f"A4, D{numero}: the lines of the delivered files, numbered as they stand, are in the order of {spec.sort}."


_ordered(212)
_ordered(213)


# -- A3: accumulated strings --------------------------------------------------
_WIDTH = 200


@register("violation_lines", f"""
WITH bad AS (SELECT DISTINCT c_name AS v FROM customer WHERE c_custkey % 3 = 0),
     starts AS (SELECT v, coalesce(sum(length(v) + 2) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM bad),
     lines AS (SELECT start // {_WIDTH} AS l, string_agg(v, ', ' ORDER BY v) AS "values" FROM starts GROUP BY 1)
SELECT 'customer' AS report, 'c_name' AS "column", row_number() OVER (ORDER BY l) AS line_no, "values" FROM lines""")
def violation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: names that a catalog does not have, joined in order into lines of bounded length."""
    from periodica.operators.joins import catalog_violations
    from periodica.operators.joins import violation_lines as lines
    c = td.table(spark, sf_dir, "customer")
    catalog = c.where("c_custkey % 3 <> 0").select(F.col("c_name").alias("key"))
    return lines(catalog_violations(c, "c_name", catalog, "customer"), _WIDTH)


# -- V9: keys of mixed form in a catalog check --------------------------------
@register("catalog_mixed_keys", """
SELECT 'orders' AS report, 'o_custkey' AS "column", lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS value, count(*) AS n_rows
FROM orders WHERE o_custkey % 7 = 3 GROUP BY 3""")
def catalog_mixed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: numbers against a catalog of zero-padded texts."""
    from periodica.operators.joins import catalog_violations
    catalog = td.table(spark, sf_dir, "customer").where("c_custkey % 7 <> 3").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("key"))
    return catalog_violations(td.table(spark, sf_dir, "orders"), "o_custkey", catalog, "orders", pad_width=9)


# -- migrations ---------------------------------------------------------------
def _stored_orders(spark: SparkSession, sf_dir: str):
    lake, spec, _ = _orders_table(spark, sf_dir)
    return lake, spec, lake.report_table(spec)


def _done(out: dict) -> str:
    if out["status"] != "Exitoso":
        raise RuntimeError(str(out))
    return out["table"]


_STEPS = (
    mg.AddColumn("FE_ALTA", "date", dt.date(1900, 1, 1)),       # E3
    mg.AddColumn("CANAL", "varchar(5)", "N/A"),                 # E2
    mg.Retype("o_orderstatus", "varchar(3)"),                   # E9
    mg.Rename("o_custkey", "CLIENTE"), mg.Rename("CLIENTE", "o_custkey"),   # E6
    mg.Drop(("o_orderpriority",)), mg.AddColumn("o_orderpriority", "varchar(15)", ""),   # E8, E15
    mg.Tighten("CANAL"), mg.Loosen("o_totalprice"),             # E12
)


@register("migrate_layout", """
SELECT v.name, v.type, v.required FROM (VALUES
 ('ID', 'string', false), ('o_orderkey', 'bigint', true), ('o_custkey', 'bigint', true), ('o_orderstatus', 'varchar(3)', true),
 ('o_totalprice', 'decimal(12,2)', false), ('o_orderdate', 'date', true), ('FECHA_EXTRACCION', 'timestamp_ntz', false),
 ('FE_ALTA', 'date', false), ('CANAL', 'varchar(5)', true), ('o_orderpriority', 'varchar(15)', false), ('period_start', 'date', false))
 AS v(name, type, required), (SELECT count(*) AS n FROM orders) o WHERE o.n > 0""")
def migrate_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog declares after a migration of the stored orders."""
    _, _, table = _stored_orders(spark, sf_dir)
    types, required = mg.declared_layout(spark, _done(mg.migrate_table(spark, table, _STEPS, ["ID"])))
    return spark.createDataFrame([(n, t, n in required) for n, t in types.items()], "name string, type string, required boolean")


@register("migrate_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       DATE '1900-01-01' AS FE_ALTA, 'N/A' AS CANAL, '' AS o_orderpriority FROM orders""")
def migrate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after the same migration, run twice, and under a new name."""
    lake, _, table = _stored_orders(spark, sf_dir)
    _done(mg.migrate_table(spark, table, _STEPS, ["ID"]))
    name = _done(mg.migrate_table(spark, table, (), ["ID"], new_name=lake.fq(SILVER, "orders_renamed")))
    if lake.exists(table):
        raise RuntimeError("the old name is still there")
    return spark.table(name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                    "FE_ALTA", "CANAL", "o_orderpriority")


@register("migrate_tighten", """
SELECT o_orderkey, 'NOTA' AS field, CAST(NULL AS VARCHAR) AS value FROM orders WHERE o_orderkey % 10 = 0""")
def migrate_tighten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tightening is refused while a NULL is there, and names its rows."""
    lake = scratch_lake(spark)
    spec = ORDERS.with_version(columns=ORDERS.columns + parse_layout("NOTA varchar(10) ?"))
    note = F.when(F.col("o_orderkey") % 10 != 0, F.lit("nota"))
    reports.backfill(spark, lake, spec, td.orders_landing(spark, sf_dir).withColumn("NOTA", note))
    out = mg.migrate_table(spark, lake.report_table(spec), (mg.Tighten("NOTA"),), ["o_orderkey"])
    if out["status"] != "Error" or out["nulls"] != out["rejects"].count() or "NOTA" in mg.declared_layout(spark, lake.report_table(spec))[1]:
        raise RuntimeError(str(out))
    return out["rejects"]


@register("migrate_conforms", """
SELECT 'n_rows' AS what, count(*) AS n FROM orders UNION ALL SELECT 'missing', 1 FROM (SELECT count(*) FROM orders) t
UNION ALL SELECT 'type', 1 FROM (SELECT count(*) FROM orders) t""")
def migrate_conforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a migration the stored table is compared with a layout: one column is
    missing and one has another type; rows are all there. E19: a missing table stops."""
    lake, spec, table = _stored_orders(spark, sf_dir)
    try:
        mg.migrate_table(spark, lake.fq(SILVER, "missing"), (), ["ID"])
        raise RuntimeError("a missing table must stop the migration")
    except LookupError:
        pass
    _done(mg.migrate_table(spark, table, (mg.Retype("o_orderstatus", "varchar(3)"), mg.Drop(("o_orderpriority",))), ["ID"]))
    found = ql.table_vs_layout(spark, spark.table(table), spec).where("finding IN ('missing', 'extra', 'type')")
    rows = spark.table(table).groupBy(F.lit("n_rows").alias("what")).agg(F.count("*").alias("n"))
    return rows.unionByName(found.groupBy(F.col("finding").alias("what")).agg(F.count("*").alias("n")))


@register("seed_defaults", """
SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_times, 1 AS n_load_times FROM orders""")
def seed_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8, S11, E18, X-14, X-15, A1: rows put into a report table without ID and load time get both."""
    lake = scratch_lake(spark)
    n = reports.seed(spark, lake, ORDERS, td.table(spark, sf_dir, "orders"))
    t = lake.report(ORDERS)
    return t.agg(F.max(F.lit(n)).cast("long").alias("n_rows"), F.count_distinct(ID_COL).alias("n_ids"),
                 F.count(LOAD_TS_COL).alias("n_times"), F.count_distinct(LOAD_TS_COL).cast("int").alias("n_load_times"))


@register("retire_report", """
SELECT o_orderstatus, count(*) AS n, false AS stored, 1 AS in_index FROM orders GROUP BY 1""")
def retire_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report goes with its table, its folders and its index row; landing and other reports stay."""
    from periodica.operators.index import index_frame, rewrite_index
    from periodica.session import path_exists
    lake, spec, table = _stored_orders(spark, sf_dir)
    index = lake.fq(SILVER, "indice_reportes")
    rewrite_index(spark, index, index_frame(spark, [(spec.numero, "ORDERS", "Mensual", False, None), (213, "CAT", "Mensual", False, None)]))
    folder = lake.location(SILVER, spec.table)
    reports.retire_report(spark, lake, spec, index)
    left = spark.table(index).count()
    stored = lake.exists(table) or path_exists(spark, folder)
    return td.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")).select(
        "*", F.lit(stored).alias("stored"), F.lit(left).cast("int").alias("in_index"))


# -- schema checks ------------------------------------------------------------
@register("landing_types", "\nUNION ALL ".join(
    f"SELECT {n} AS numero, count(*) * 0 AS findings FROM lineitem" for n in sorted(INGEST)))
def landing_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: every source's landed table, loaded from the whole table, against its report's types."""
    lake, rows = scratch_lake(spark), []
    for n, ing in sorted(INGEST.items()):
        spec = SPECS[n]
        fq = lake.ensure_landing_table(ing)
        landed = {f.name: f.dataType for f in spark.table(fq).schema}
        made = landing_frame(spark, sf_dir, spec, "lineitem")
        back = {land: stored for land, stored in spec.load_renames}
        want = {c.name: c.type for c in spec.stored_columns}
        bad = ql.landing_vs_report(spark, ing, spec).count()
        bad += sum(1 for c, t in landed.items() if back.get(c, c) in want and want[back.get(c, c)].kind in ("date", "numeric")
                   and t != want[back.get(c, c)].spark)
        bad += sum(1 for c in made.columns if c not in landed and c != LOAD_TS_COL)
        rows.append((n, bad))
    return spark.createDataFrame(rows, "numero int, findings long")


@register("spec_rules", """
SELECT v.numero, v.rule FROM (VALUES (901, 'V5'), (902, 'V6'), (903, 'V10')) AS v(numero, rule), (SELECT count(*) AS n FROM orders) o WHERE o.n > 0""")
def spec_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit column that is delivered, an information date that is not the
    last column, a control column that no file feeds; the 23 reports have none of them
    but those that their own layouts demand."""
    import dataclasses
    base = ORDERS.columns
    shown = ORDERS.with_version(numero=901, columns=base + parse_layout("ID varchar(36)"))
    early = ORDERS.with_version(numero=902, columns=parse_layout("FECHA_INFO date ymd") + base)
    unfed = dataclasses.replace(INGEST[154], final_columns=tuple(c for c in INGEST[154].final_columns if c != SPECS[154].control))
    stored = set(_stored_orders(spark, sf_dir)[0].report(ORDERS).columns)
    found = [(s.numero, r) for s in (shown, early) for r, _ in ql.spec_findings(s) if {c.name for c in base} <= stored]
    found += [(903, r) for r, _ in ql.spec_findings(SPECS[154], unfed)]
    found += [(n, r) for n, s in SPECS.items() for r, _ in ql.spec_findings(s, INGEST.get(n)) if r != "V6"]
    return spark.createDataFrame(found, "numero int, rule string")


@register("required_columns", """
SELECT c.name AS "column", c.status FROM (VALUES ('o_orderkey', 'OK'), ('O_ORDERDATE', 'OK'), ('FECHA_EXTRACCION', 'OK'), ('NO_EXISTE', 'FALTA'))
 AS c(name, status), (SELECT count(*) AS n FROM orders) o WHERE o.n > 0""")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns against the catalog's own metadata of a stored report."""
    from periodica.operators.joins import catalog_columns
    from periodica.operators.joins import required_columns as required
    _, _, table = _stored_orders(spark, sf_dir)
    want = spark.createDataFrame([(table, c) for c in ("o_orderkey", "O_ORDERDATE", "FECHA_EXTRACCION", "NO_EXISTE")], "table string, column string")
    return required(want, catalog_columns(spark, [table])).select("column", "status")


# -- small predicates over whole tables ---------------------------------------
@register("in_list_windows", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, count(*) AS n, true AS has_rows FROM orders
WHERE CAST(date_trunc('month', o_orderdate) AS DATE) IN (DATE '1995-03-01', DATE '1996-07-01') GROUP BY 1""")
def in_list_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """an IN list of windows prunes partitions; the EXISTS guard reads one row; F10: the
    legacy range from a day to itself holds nothing."""
    from periodica.functions.periods import DAILY, Window, in_window
    from periodica.sources.tables import window_has_rows
    lake, spec, _ = _stored_orders(spark, sf_dir)
    rows = lake.report(spec).where(F.col("period_start").isin([dt.date(1995, 3, 1), dt.date(1996, 7, 1)]))
    nothing = lake.report(spec).where(in_window("o_orderdate", Window(DAILY, dt.date(1995, 3, 15), dt.date(1995, 3, 15))))
    guard = window_has_rows(rows) and not window_has_rows(nothing)
    return rows.groupBy("period_start").agg(F.count("*").alias("n")).withColumn("has_rows", F.lit(guard))


@register("date_texts", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_120, strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS by_layout,
       CAST(o_orderdate AS DATE) AS from_compact FROM orders""")
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-4, X-8, X-22: a date form taken from layout text, style 120, and compact literals."""
    from periodica.functions.formats import compact_date, render_date, render_ts_120
    form = parse_layout("D date dmy")[0].fmt
    o = td.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", render_ts_120(F.col("o_orderdate").cast("timestamp_ntz")).alias("ts_120"),
                    render_date(F.to_date("o_orderdate"), form).alias("by_layout"),
                    F.when(F.to_date("o_orderdate") >= F.lit(compact_date("19000101")).cast("date"), F.to_date("o_orderdate")).alias("from_compact"))


@register("index_order", """
SELECT row_number() OVER (ORDER BY n_nationkey) AS line, n_nationkey AS numero, n_name AS nombre FROM nation""")
def index_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the index in its listing order, each row with its line number."""
    from periodica.operators.ordered import numbered_lines
    n = td.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("numero"), F.col("n_name").alias("nombre"))
    return numbered_lines(n, [F.col("numero").asc()]).select("line", "numero", "nombre")

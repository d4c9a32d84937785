"""Index (S16-S18), joins (J1-J5), quality (V1-V10) and migration."""
import datetime as dt

import dataclasses

import pytest
from pyspark.sql import functions as F

from periodica.layouts import INGEST, SPECS
from periodica.operators import migrate as mg
from periodica.operators.index import index_delete, index_frame, index_update, index_upsert
from periodica.operators.joins import catalog_violations, orphan_keys, presence
from periodica.operators.quality import (landing_vs_report, quality_scan, schema_diff,
                                         schema_of_frame, schema_of_layout, spec_findings)
from periodica.spec import LayoutColumn, parse_layout


def test_index_ops(spark):
    idx = index_frame(spark, [(212, "SECCION_5", "Mensual", False, None), (213, "CAT", "Mensual", True, None)])
    ch = index_frame(spark, [(212, "SECCION_5_LINEAS_CRE", "Mensual", False, None),
                             (209, "LID", "Mensual", True, "f.txt")])
    up = {r["numero"]: r for r in index_upsert(idx, ch).collect()}
    assert set(up) == {209, 212, 213} and up[212]["nombre"] == "SECCION_5_LINEAS_CRE"
    new, changed = index_update(idx, 213, "nombre", "CAT")
    assert new.where(changed).count() == 0                  # only if different
    new, changed = index_update(idx, 213, "nombre", "CAT_LINEAS")
    assert new.where(changed).count() == 1
    assert [r["numero"] for r in index_delete(idx, 212).collect()] == [213]


def test_presence_orphans_catalog(spark):
    req = spark.createDataFrame([("A",), ("B",)], "name string")
    ex = spark.createDataFrame([("A",)], "name string")
    assert {(r[0], r[1]) for r in presence(req, ex, "name").collect()} == {("A", "OK"), ("B", "FALTA")}
    child = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    assert [tuple(r) for r in orphan_keys(child, "k", parent, "k").collect()] == [(3, 1)]
    cat = spark.createDataFrame([("MXN",), ("USD",)], "key string")
    df = spark.createDataFrame([("MXN",), ("EUR",), ("EUR",), (None,)], "m string")
    got = [tuple(r) for r in catalog_violations(df, "m", cat, "r").collect()]
    assert got == [("r", "m", "EUR", 2)]


def test_quality_scan_one_pass(spark):
    cols = parse_layout("a varchar(3) | n numeric(4,2) | d date ?")
    df = spark.createDataFrame([("abcd", "123.4", None), (None, "1.5", None)], "a string, n string, d date")
    got = {(r["field"], r["rule"]): r["n_rows"] for r in quality_scan(df, cols).collect()}
    assert got == {("a", "null"): 1, ("a", "varchar(3)"): 1, ("n", "null"): 0,
                   ("n", "numeric(4,2)"): 1, ("d", "date"): 0}


def test_schema_diff_findings(spark):
    exp = schema_of_layout(spark, parse_layout("A varchar(3) | B date | C numeric(12,0)"))
    act = schema_of_frame(spark, spark.createDataFrame([], "a string, C int, X string, B date").schema)
    got = {(r["name"], r["finding"]) for r in schema_diff(exp, act).collect()}
    assert ("A", "case") in got and ("A", "type") in got and ("C", "type") in got
    assert ("X", "extra") in got and ("B", "order") in got


def test_spec_findings_v10():
    # the shipped sources whose files lack the control column land the run date
    assert {n for n in INGEST if INGEST[n].control_from == "run_date"} == {76, 93, 140}
    assert not any(f[0] == "V10" for n in INGEST for f in spec_findings(SPECS[n], INGEST[n]))
    by_column = {n: dataclasses.replace(INGEST[n], control_from="column") for n in INGEST}
    flagged = {n for n in INGEST if any(f[0] == "V10" for f in spec_findings(SPECS[n], by_column[n]))}
    assert flagged == {76, 93, 140}
    assert all(not spec_findings(s) for s in SPECS.values())  # V5, V6 hold for every layout


def test_landing_vs_report_types(spark):
    assert landing_vs_report(spark, INGEST[154], SPECS[154]).count() == 0


def test_migrate_idempotent_and_lossless_check(spark):
    df = spark.createDataFrame([(1, "abc", 5, None), (2, "de", 1234567, 2.5)],
                               "k int, Name string, n int, v double")
    steps = (mg.Rename("Name", "NAME"), mg.Retype("n", "numeric(12,0)"), mg.AddColumn("F", "date"),
             mg.AddColumn("M", "varchar(2)", ""), mg.Backfill("v", 0), mg.Drop(("zzz",)))
    once = mg.migrate(df, steps)
    twice = mg.migrate(once, steps)
    assert once.columns == ["k", "NAME", "n", "v", "F", "M"] == twice.columns
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    rej = mg.migration_rejects(df, (mg.Retype("n", "numeric(3,0)"),), ["k"]).collect()
    assert [(r["k"], r["value"]) for r in rej] == [(2, "1234567")]
    narrow = mg.truncated_rows(df, (mg.Truncate("Name", 2),), ["k"]).collect()
    assert [r["k"] for r in narrow] == [1]


def test_migrate_table_preflight_and_swap(spark, lake):
    with pytest.raises(LookupError):
        mg.migrate_table(spark, lake.fq("silver", "missing"), (), ["k"])   # E19
    fq = lake.fq("silver", "t")
    spark.createDataFrame([(1, 3)], "k int, n int").write.option("path", lake.location("silver", "t")).saveAsTable(fq)
    bad = mg.migrate_table(spark, fq, (mg.Retype("n", "varchar(0)"),), ["k"])
    assert bad["status"] == "Error" and spark.table(fq).columns == ["k", "n"]  # nothing swapped
    ok = mg.migrate_table(spark, fq, (mg.Retype("n", "numeric(12,0)"),), ["k"], new_name=lake.fq("silver", "t2"))
    assert ok["status"] == "Exitoso" and str(spark.table(ok["table"]).schema["n"].dataType) == "DecimalType(12,0)"


def test_retire_report(spark, lake):
    from periodica.operators.index import rewrite_index
    from periodica.plans import reports
    spec = SPECS[212]
    lake.ensure_report_table(spec)
    idx_t = lake.fq("silver", "indice_reportes")
    rewrite_index(spark, idx_t, index_frame(spark, [(212, "S5", "Mensual", False, None),
                                                     (213, "CAT", "Mensual", False, None)]))
    out = reports.retire_report(spark, lake, spec, idx_t)
    assert out == {"index_rows_removed": 1, "table_dropped": True}
    assert [r[0] for r in spark.table(idx_t).collect()] == [213]


def test_placeholder_date_and_post_migration_check(spark, lake):
    """Existing rows get the 1900-01-01 placeholder; E20: the migrated table
    conforms to the new layout (V3 returns no finding)."""
    from periodica.operators.quality import table_vs_layout
    from periodica.spec import ReportSpec
    old = ReportSpec(numero=999, name="999_T", frequency="monthly", control="D",
                     columns=parse_layout("A varchar(3) | D date ymd"))
    new = old.with_version(columns=parse_layout("A varchar(3) | FE date ymd | D date ymd"))
    from periodica.plans import reports
    reports.seed(spark, lake, old, spark.createDataFrame([("abc", dt.date(2026, 6, 1))], "A string, D date"))
    fq = lake.report_table(old)
    out = mg.migrate_table(spark, fq, (mg.AddColumn("FE", "date", dt.date(1900, 1, 1)),), ["ID"])
    assert out["status"] == "Exitoso"
    df = spark.table(fq)
    assert df.first()["FE"] == dt.date(1900, 1, 1)
    moved = df.select("ID", "A", "FE", "D", "FECHA_EXTRACCION", "period_start")
    assert table_vs_layout(spark, moved, new).where(F.col("finding") != "nullable").count() == 0


def test_mixed_format_keys_and_required_columns(spark, lake):
    """V9: '000780' and 780 are the same catalog key; J1/J2 on catalog metadata."""
    from periodica.operators.joins import catalog_columns, required_columns
    cat = spark.createDataFrame([("000780",), ("000111",)], "key string")
    df = spark.createDataFrame([(780,), (111,), (5,)], "k int")
    got = [tuple(r) for r in catalog_violations(df, "k", cat, "r", pad_width=6).collect()]
    assert got == [("r", "k", "000005", 1)]
    spec = SPECS[209]
    t = lake.ensure_report_table(spec)
    req = spark.createDataFrame([(t, "FECHA_LIQ"), (t, "fecha_info"), (t, "NO_EXISTE")], "table string, column string")
    st = {r["column"]: r["status"] for r in required_columns(req, catalog_columns(spark, [t])).collect()}
    assert st == {"FECHA_LIQ": "OK", "fecha_info": "OK", "NO_EXISTE": "FALTA"}


def test_landing_coverage_null_bucket(spark):
    from periodica.operators.quality import landing_coverage
    from periodica.plans import testdata as td
    df = spark.createDataFrame([(dt.date(1995, 3, 1),), (dt.date(1995, 3, 9),), (None,)], "l_shipdate date")
    got = {(r["window_start"], r["n_rows"], r["null_control"]) for r in landing_coverage(df, td.lineitem_spec()).collect()}
    assert got == {(dt.date(1995, 3, 1), 2, False), (None, 1, True)}


def test_report_catalog_bindings(spark):
    """J5 per report: bound columns checked against supplied catalogs, mixed
    numeric / text keys normalised (V9); unsupplied catalogs are skipped."""
    from periodica.operators.joins import report_catalog_violations
    spec = SPECS[142]
    rows = spark.createDataFrame([("A", "000780", 1, 1), ("Z", "780", 7, 9), ("R", "1234", 9, 2)],
                                 "OFICINA string, CONT string, NETEO_POS int, TIP_CONTRAT int")
    cats = {"ANEXO A": spark.createDataFrame([("A",), ("R",), ("F",)], "key string"),
            "ANEXO B": spark.createDataFrame([(780,), (111,)], "key int"),
            "ANEXO M": spark.createDataFrame([(str(k),) for k in (1, 2, 3, 4, 5, 6, 9)], "key string")}
    got = sorted(tuple(r) for r in report_catalog_violations(spec, rows, cats).collect())
    assert got == [("142_ENT_GARANTIAS_IV", "CONT", "001234", 1),
                   ("142_ENT_GARANTIAS_IV", "NETEO_POS", "7", 1),
                   ("142_ENT_GARANTIAS_IV", "OFICINA", "Z", 1)]
    assert report_catalog_violations(SPECS[21], rows, cats) is None


def test_report_relations(spark, lake):
    """J3 212 -> 213 and J4 155 with 156 over stored report tables."""
    from periodica.plans import reports
    s212, s213 = SPECS[212], SPECS[213]
    base = dict(FECHA_INFO=dt.date(2026, 6, 5))
    r212 = [{**{c.name: None for c in s212.stored_columns}, **base, "ID_LINEA": k, "FECHA_EJE": dt.date(2026, 6, 1)}
            for k in ("L1", "L2", "L2", "L9")]
    r213 = [{**{c.name: None for c in s213.stored_columns}, **base, "ID_LINEA": k} for k in ("L1", "L2")]
    reports.seed(spark, lake, s212, spark.createDataFrame(r212, _schema(s212)))
    reports.seed(spark, lake, s213, spark.createDataFrame(r213, _schema(s213)))
    assert [tuple(r) for r in reports.referential_violations(spark, lake, 212).collect()] == [("L9", 1)]
    s155, s156 = SPECS[155], SPECS[156]
    day = dt.date(2026, 6, 5)
    r155 = [{**{c.name: None for c in s155.stored_columns}, "NU_ID": k, "FE_CON_OPE": day} for k in ("A", "B")]
    r156 = [{**{c.name: None for c in s156.stored_columns}, "NU_ID": k, "FECHA": day} for k in ("A", "C")]
    reports.seed(spark, lake, s155, spark.createDataFrame(r155, _schema(s155)))
    reports.seed(spark, lake, s156, spark.createDataFrame(r156, _schema(s156)))
    assert [r["NU_ID"] for r in reports.companion_rows(spark, lake, 155, day).collect()] == ["A"]


def _schema(spec):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(c.name, c.type.spark, True) for c in spec.stored_columns])


def test_migration_rejects_rounding_and_reports_cuts_after_a_rename(spark):
    df = spark.createDataFrame([(1, 1.234567, "1.7", "abcdef"), (2, 1.25, "2", "ab"), (3, None, "x", None)],
                               "ID int, a double, b string, c string")
    steps = (mg.Retype("a", "numeric(12,2)"), mg.Retype("b", "numeric(2,0)"))
    lost = {(r["ID"], r["field"], r["value"]) for r in mg.migration_rejects(df, steps, ["ID"]).collect()}
    assert lost == {(1, "a", "1.234567"), (1, "b", "1.7"), (3, "b", "x")}
    cut = mg.truncated_rows(df, (mg.Rename("c", "d"), mg.Truncate("d", 3)), ["ID"]).collect()
    assert [tuple(r) for r in cut] == [(1, "d", "abcdef")]

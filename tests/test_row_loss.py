"""Ways in which rows got lost or doubled, and an oracle that notices swapped columns."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from periodica.functions.periods import DAILY, FREQUENCIES, MONTHLY, overlapping_periods, window_for
from periodica.layouts import SPECS
from periodica.plans import report_queries, reports
from periodica.plans import testdata as td
from periodica.session import ensure_shared_dir
from periodica.sources.ingest import ingest
from periodica.spec import IngestSpec


def test_every_stored_period_of_a_window_is_kept(spark):
    days = [dt.date(2023, 12, 1) + dt.timedelta(days=i) for i in range(150)]
    for stored in FREQUENCIES:
        starts = sorted({window_for(d, stored).start for d in days})
        df = spark.createDataFrame([(s,) for s in starts], "p date")
        for asked in FREQUENCIES:
            for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 28)):
                w = window_for(day, asked)
                kept = {r.p for r in df.where(overlapping_periods("p", w)).collect()}
                needed = {s for s in starts if any(w.contains(d) for d in days if window_for(d, stored).start == s)}
                assert needed <= kept


def test_bounded_backfill_is_pruned(spark, lake, capsys):
    landing = td.orders_landing(spark, SF_SMALL).withColumn("landing_month", F.trunc("o_orderdate", "month"))
    spec = td.orders_spec(MONTHLY)
    reports.backfill(spark, lake, spec, landing, first="1995-03-01", last="1995-03-31", landing_control="o_orderdate")
    path = f"{lake.root}/landing"
    landing.write.partitionBy("landing_month").parquet(path)
    src = reports._pruned(spark.read.parquet(path), "o_orderdate", window_for("1995-03-15", MONTHLY), "o_orderdate")
    plan = src._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landing_month" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_ingest_stops_without_a_control_column(spark, lake):
    spec = IngestSpec(name="X", file_pattern=".*", landing="LMDA.X", column_map=(("a", "a"),), final_columns=("ID", "a"), control_col="FECHA")
    with pytest.raises(ValueError, match="V10"):
        ingest(spark, lake, spec, ["file:/none.csv"])


def test_failed_load_is_logged_whole(spark, lake):
    spec = td.orders_spec(DAILY)
    res = reports.load(spark, lake, spec, "1995-03-15", landing=td.orders_landing(spark, SF_SMALL).drop("o_custkey"))
    assert not res.ok and "o_custkey" in res.message
    log = spark.table(lake.fq("silver", reports.RUN_LOG)).collect()
    assert len(log) == 1 and log[0]["MensajeError"] == res.message
    assert dict(spark.table(lake.fq("silver", reports.RUN_LOG)).dtypes)["FilasInsertadas"] == "bigint"


def test_no_shared_folder_is_an_error_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("Sc", (), {"master": "spark://host:7077"})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_shared_dir(Cluster())


@pytest.mark.parametrize("numero", [154, 121, 75])
def test_oracle_tells_columns_apart(spark, numero):
    """Swapping any two columns of one type, or the control column, changes the oracle's rows."""
    duckdb = pytest.importorskip("duckdb")
    spec, day = SPECS[numero], report_queries.LINE_DAY
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF_SMALL}/lineitem.parquet'")
    row = con.execute(report_queries.oracle(spec, "lineitem", day)).fetchone()
    by_type: dict = {}
    for c, v in zip(spec.columns, row):
        by_type.setdefault((c.type, c.fmt), []).append(v)
    for (kind, _), values in by_type.items():
        if kind.kind in ("date", "text") or kind.kind == "varchar" and kind.length > 3:
            assert len(set(values)) == len(values)
    names = [c.name for c in spec.stored_columns if c.type.kind == "date"]
    controls = {report_queries.stored_expr(spec, n, "lineitem") for n in names}
    assert len(controls) == len(names)


def test_a_new_session_attaches_the_migrated_folder(spark, lake):
    """A migration moves a table's folder; its definition lost (a session catalog),
    the table is attached where it is, and older folders go one migration later."""
    from periodica.operators import migrate as mg
    from periodica.session import path_exists, read_lines
    spec = td.orders_spec(MONTHLY)
    reports.load(spark, lake, spec, "1995-03-15", landing=td.orders_landing(spark, SF_SMALL))
    table, n = lake.report_table(spec), spark.table(lake.report_table(spec)).count()
    standard = lake.location("silver", spec.table)
    folders = [standard]
    for i in range(2):
        assert mg.migrate_table(spark, table, (mg.AddColumn(f"extra{i}", "int"),), keys=["ID"])["status"] == "Exitoso"
        folders.append(lake.location("silver", spec.table))
    assert len(set(folders)) == 3 and read_lines(spark, standard + ".location") == [folders[2], folders[1]]
    assert [path_exists(spark, f) for f in folders] == [False, True, True]
    spark.sql(f"DROP TABLE {table}")
    lake.ensure_report_table(spec)
    assert spark.table(table).count() == n
    reports.retire_report(spark, lake, spec)
    assert not any(path_exists(spark, f) for f in [*folders, standard + ".location"])

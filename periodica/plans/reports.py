"""Per-report jobs: ``load`` (L*), ``self_refresh`` and ``deliver`` (D*), all
driven by a ``ReportSpec``; one generic operator serves the 23 reports and their
earlier versions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import Window, in_window, period_start, window_for
from periodica.operators.conformance import conform, violation_reason
from periodica.operators.deliver import deliver_rows
from periodica.operators.window_sink import REASON_COL, RunResult, failed, replace_by, replace_window
from periodica.sources.tables import BRONZE, Lake, scan_window
from periodica.sources.versions import forget_windows
from periodica.spec import ID_COL, LANDING_PART_COL, LOAD_TS_COL, PERIOD_COL, ReportSpec


RUN_LOG = "run_log"
MSG_NO_LOG = "Sin registro en la bitacora: {e}"
DATED = ("date", "timestamp", "timestamp_ntz")


def _job(spec: ReportSpec) -> str:
    return f"[{spec.name}]"


def _inject(df: DataFrame, spec: ReportSpec, day: dt.date, start: Column) -> DataFrame:
    """Overwrite the information date (X6): with the run day, or with the
    period start (earlier versions)."""
    value = {"run_day": F.lit(day), "period_start": start}.get(spec.inject)
    if value is None:
        return df
    # the landing column that feeds the injected one, where it has another name
    names = {stored: land for land, stored in spec.load_renames}
    name = names.get(spec.inject_col, spec.inject_col)
    return df.withColumn(name if name in df.columns else spec.inject_col, value)


def _control_source(spec: ReportSpec) -> str:
    return {stored: land for land, stored in spec.load_renames}.get(spec.control, spec.control)


def _pruned(landing: DataFrame, control: str, window: Window, landing_control: str | None) -> DataFrame:
    """The window's landing rows. Months are pruned only where landing is
    partitioned by the month of this very control column; the range on the
    column itself is always there, and pushed to Parquet."""
    src = landing
    if landing_control == control and LANDING_PART_COL in landing.columns:
        last = window.end - dt.timedelta(days=1)
        src = src.where((F.col(LANDING_PART_COL) >= F.lit(window.start.replace(day=1)))
                        & (F.col(LANDING_PART_COL) <= F.lit(last.replace(day=1))))
    day = F.col(control)
    if src.schema[control].dataType.typeName() not in DATED:
        day = day.try_cast("date")      # a text that is no date is in no window
    return src.where(in_window(day, window))


def _stored(spec: ReportSpec, src: DataFrame, landing: DataFrame, *more: str) -> DataFrame:
    """Landing rows as the report stores them, with a violation reason per row.
    The landing ID and load time are carried through, so a re-run writes
    identical rows (X5)."""
    renames = {stored: land for land, stored in spec.load_renames}
    cols = [c for c in spec.stored_columns if c.name != LOAD_TS_COL]
    return src.select(
        F.col(ID_COL).cast("string").alias(ID_COL),
        *conform(cols, renames),
        F.col(LOAD_TS_COL).cast("timestamp_ntz").alias(LOAD_TS_COL),
        violation_reason(cols, renames, _types(landing)).alias(REASON_COL), *more)


def load_rows(spec: ReportSpec, landing: DataFrame, window: Window, day: dt.date,
              landing_control: str | None = None) -> DataFrame:
    """Rows a landing-sourced load writes for ``window``: landing columns mapped
    to the stored names and converted to the declared types. ``landing_control``
    names the column by whose month landing is partitioned, if that is one."""
    src = _pruned(landing, _control_source(spec), window, landing_control)
    return _stored(spec, _inject(src, spec, day, F.lit(window.start)), landing)


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def load(spark: SparkSession, lake: Lake, spec: ReportSpec, system_date,
         landing: DataFrame | None = None, scheduler: str | None = None,
         landing_control: str | None = None) -> RunResult:
    """``load(spec, system_date)`` for a landing-sourced report (L*)."""
    if spec.source == "self":
        return self_refresh(spark, lake, spec, system_date, scheduler=scheduler)
    day = window_for(system_date, "daily").start
    window = window_for(day, spec.frequency)
    target = lake.ensure_report_table(spec)

    def rows() -> DataFrame:
        src, by = landing, landing_control
        if src is None:
            from periodica.layouts import INGEST
            fq = lake.fq(BRONZE, INGEST[spec.numero].landing_table)
            src, by = spark.table(fq), lake.landing_control(fq)
        return load_rows(spec, src, window, day, by)
    if spec.delete_on:
        return _logged(spark, lake, replace_by(
            spark, target, rows(), window, spec.delete_on, spec.frequency, spec.control, _job(spec),
            quarantine_table=lake.fq("silver", "quarantine"), scheduler=scheduler))
    return _logged(spark, lake, replace_window(
        spark, target, rows, window, _job(spec), quarantine_table=lake.fq("silver", "quarantine"),
        scheduler=scheduler))


def _logged(spark: SparkSession, lake: Lake, result):
    """Append the run log rows of a result, or of a list of them (S15), failures included.
    A window that is stored stays a success when its log row cannot be written."""
    from periodica.operators.runlog import log_run
    results = result if isinstance(result, list) else [result]
    try:
        log_run(spark, lake.fq("silver", RUN_LOG), results)
    except Exception as e:
        for r in results:
            r.log(MSG_NO_LOG.format(e=e))
    return result


def self_refresh(spark: SparkSession, lake: Lake, spec: ReportSpec, system_date,
                 scheduler: str | None = None) -> RunResult:
    """Self-select load: the window is re-computed from its committed version (fix of
    X1), with the injected date applied. The version it read stays as it is until the
    new one is committed, and is read again where another run commits first."""
    day = window_for(system_date, "daily").start
    window = window_for(day, spec.frequency)
    target = lake.report_table(spec)
    lake.require(target)

    def rows() -> DataFrame:
        snap = scan_window(lake.report(spec), spec.control, window, partitioned=True).drop(PERIOD_COL)
        snap = _inject(snap, spec, day, F.lit(window.start))
        return snap.withColumn(REASON_COL, violation_reason(spec.stored_columns, None, _types(snap)))
    return _logged(spark, lake, replace_window(
        spark, target, rows, window, _job(spec), quarantine_table=lake.fq("silver", "quarantine"),
        scheduler=scheduler))


def deliver(spark: SparkSession, lake: Lake, spec: ReportSpec, date) -> DataFrame:
    """``deliver(spec, date)`` (D*): read-only, one window, layout order."""
    window = window_for(date, spec.frequency)
    return deliver_rows(lake.report(spec), spec, window, partitioned=True)


def seed(spark: SparkSession, lake: Lake, spec: ReportSpec, rows: DataFrame) -> int:
    """Put rows straight into a report table, each in the partition of its own
    control date (fixture seeding, S11). Returns the row count of the table."""
    target = lake.ensure_report_table(spec)
    cols = [c for c in spark.table(target).columns]
    df = rows
    if ID_COL not in df.columns:
        df = df.withColumn(ID_COL, F.expr("uuid()"))
    if LOAD_TS_COL not in df.columns:
        from periodica.functions.periods import minute_rounded
        df = df.withColumn(LOAD_TS_COL, minute_rounded(F.current_timestamp().cast("timestamp_ntz")))
    df = df.withColumn(PERIOD_COL, period_start(spec.control, spec.frequency))
    types = {c.name: c.type for c in spec.stored_columns}
    from periodica.functions.types import typed
    sel = [typed(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in cols]
    df.select(*sel).write.insertInto(target, overwrite=False)
    return spark.table(target).count()


def backfill(spark: SparkSession, lake: Lake, spec: ReportSpec, landing: DataFrame,
             first=None, last=None, scheduler: str | None = None, landing_control: str | None = None,
             run_day=None) -> list[RunResult]:
    """Load every window of a landing frame (or the windows between ``first``
    and ``last``) in one job: initial loads, re-loads after a landing
    correction, and frequency changes. Same rows as one ``load`` per window
    (on ``run_day``, where the report injects it). A bounded backfill reads the
    range of the control column only, so rows without a valid control date show
    up in unbounded ones."""
    from periodica.functions.periods import window_for as wf
    from periodica.operators.window_sink import replace_windows
    target = lake.ensure_report_table(spec)
    control = _control_source(spec)
    started = dt.datetime.now()
    f = wf(first, spec.frequency) if first is not None else None
    la = wf(last, spec.frequency) if last is not None else None
    try:
        src = landing
        if f or la:
            bounds = Window(spec.frequency, f.start if f else dt.date(1, 1, 1), la.end if la else dt.date(9999, 12, 31))
            src = _pruned(src, control, bounds, landing_control)
        day = F.col(control) if landing.schema[control].dataType.typeName() in DATED else F.col(control).try_cast("date")
        src = src.withColumn(PERIOD_COL, period_start(day, spec.frequency))
        run_day = wf(run_day, "daily").start if run_day is not None else dt.date.today()
        rows = _stored(spec, _inject(src, spec, run_day, F.col(PERIOD_COL)), landing, PERIOD_COL)
        results = replace_windows(
            spark, target, rows, spec.frequency, spec.control, _job(spec), first=f.start if f else None,
            last=la.start if la else None, scheduler=scheduler, quarantine_table=lake.fq("silver", "quarantine"))
    except Exception as e:      # a row in the log, as for a single load; no window is named
        results = [failed(RunResult(job=_job(spec), window=None, started=started, scheduler=scheduler), e)]
    return _logged(spark, lake, results)


def retire_report(spark: SparkSession, lake: Lake, spec: ReportSpec,
                  index_table: str | None = None) -> dict:
    """Remove a report in dependency order: its index row, then its
    stored table and data (delivery and load are functions of the spec, so
    nothing else is stored). Landing tables are shared and kept."""
    from periodica.operators.index import index_delete, rewrite_index
    from periodica.session import LOCATION_SUFFIX, delete_path, read_lines
    out = {"index_rows_removed": 0, "table_dropped": False}
    if index_table and lake.exists(index_table):
        idx = spark.table(index_table)
        before = idx.where(F.col("numero") == spec.numero).count()
        if before:
            rewrite_index(spark, index_table, index_delete(idx, spec.numero))
        out["index_rows_removed"] = before
    fq = lake.report_table(spec)
    if lake.exists(fq):
        spark.sql(f"DROP TABLE {fq}")
        forget_windows(spark, fq)
        out["table_dropped"] = True
    standard = f"{lake.root}/{lake.db('silver')}/{spec.table}"
    for path in {*read_lines(spark, standard + LOCATION_SUFFIX), standard, standard + LOCATION_SUFFIX}:
        delete_path(spark, path)
    return out


def referential_violations(spark: SparkSession, lake: Lake, child: int) -> DataFrame:
    """J3 / V8 between stored reports: child keys without a parent row, with the
    number of child rows per key (keys pre-aggregated before the join)."""
    from periodica.layouts import REFERENTIAL, SPECS
    from periodica.operators.joins import orphan_keys
    parent, key = REFERENTIAL[child]
    return orphan_keys(lake.report(SPECS[child]), key, lake.report(SPECS[parent]), key)


def _companions(spark: SparkSession, lake: Lake, numero: int, day) -> tuple[DataFrame, DataFrame, str]:
    from periodica.layouts import COMPANIONS, SPECS
    other, key = COMPANIONS[numero]
    a, b = SPECS[numero], SPECS[other]
    left = scan_window(lake.report(a), a.control, window_for(day, a.frequency), True)
    right = scan_window(lake.report(b), b.control, window_for(day, b.frequency), True)
    return left, right.select(key, *[F.col(c).alias(f"{b.table}_{c}") for c in right.columns if c != key]), key


def companion_rows(spark: SparkSession, lake: Lake, numero: int, day) -> DataFrame:
    """The window's rows of a report with its companion report's rows of the same
    window, joined by the shared key; not those of a key that both repeat."""
    from periodica.operators.joins import companion
    left, right, key = _companions(spark, lake, numero, day)
    return companion(left, right, [key])


def companion_unclear(spark: SparkSession, lake: Lake, numero: int, day) -> DataFrame:
    """The keys that a report and its companion both repeat in the window."""
    from periodica.operators.joins import companion_repeats
    left, right, key = _companions(spark, lake, numero, day)
    return companion_repeats(left, right, [key])

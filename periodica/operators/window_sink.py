"""Idempotent window replacement (S14), its counts (A2) and the run result.

``replace_window`` never leaves a window half written, and never touches the
rows it replaces:

1. the rows of the window are computed once and written to a fresh version
   folder inside the table's folder, while an ``Observation`` counts rows and
   layout violations in the same pass;
2. a window with violations is not touched: its bad rows go to quarantine and
   the run ends with status ``Error`` (the legacy insert would have failed);
3. otherwise one commit file makes that folder the window
   (``periodica.sources.versions``) and the catalog's partition is pointed to it.
   The folder of the version before stays for open readers and goes with the
   next load.

An error anywhere before the commit leaves the window as it was; one after it
leaves the new rows, which the next reader's ``sync_windows`` finds. A load that
reads its own window (self refresh) commits only if no other load committed
since it began to read; it starts over where one did.

All other windows are untouched, and an empty source empties the window.
Running the same load twice gives the same table, which is what makes re-runs
and late corrections safe. ``replace_windows`` does the same for many windows
in one job (backfills).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from periodica.functions.periods import Window, in_window, period_start, window_for
from periodica.session import delete_path
from periodica.sources.appends import append_run
from periodica.sources.versions import (VERSIONS, Version, commit_window, point_windows, sync_windows,
                                        table_location)
from periodica.spec import PERIOD_COL

REASON_COL = "_reason"

# Run statuses and log message texts of the run log.
STATUS_OK = "Exitoso"
STATUS_ERROR = "Error"
MSG_DELETED = "Registros eliminados: {n}"
MSG_DONE = "Proceso completado. Filas totales: {n}"
MSG_FAILED = "Error durante la ejecucion: {e}"
MSG_REJECTED = "{n} filas no cumplen el layout; ventana sin cambios"
MSG_BUSY = "La ventana cambio durante la ejecucion ({n} intentos)"
MSG_NO_WINDOW = "{n} filas sin fecha de control valida; en cuarentena"
CRLF = "\r\n"

TRIES = 5       # of a load whose window another load commits first


@dataclass
class RunResult:
    job: str
    window: Window | None      # None: rows that belong to no window
    deleted: int = 0
    inserted: int = 0
    rejected: int = 0
    status: str = STATUS_OK
    message: str | None = None
    details: str = ""
    started: dt.datetime = field(default_factory=dt.datetime.now)
    finished: dt.datetime | None = None
    scheduler: str | None = None
    quarantine: str | None = None

    @property
    def ok(self) -> bool:
        return self.status == STATUS_OK

    def log(self, line: str) -> None:
        self.details += line + CRLF


def failed(res: RunResult, e: Exception) -> RunResult:
    """The result of a run that an error has ended."""
    res.status, res.message = STATUS_ERROR, str(e)
    res.deleted = res.inserted = 0
    res.log(MSG_FAILED.format(e=res.message))
    res.finished = dt.datetime.now()
    return res


def partition_count(spark: SparkSession, table: str, start: dt.date) -> int:
    """Rows currently stored for one window; reads one partition only."""
    return spark.table(table).where(F.col(PERIOD_COL) == F.lit(start)).count()


QUARANTINE_SCHEMA = "job STRING, window_start DATE, reason STRING, row STRING"


def quarantine_rows(staged: DataFrame, table: str, job: str, window_start) -> None:
    """Append the violating rows as JSON: one fixed schema for the rows of all
    reports, of single loads and of backfills, and one folder for each run."""
    data = [c for c in staged.columns if c not in (REASON_COL, PERIOD_COL)]
    append_run(staged.sparkSession, table, staged.where(F.col(REASON_COL) != "").select(
        F.lit(job).alias("job"), window_start.cast("date").alias("window_start"),
        F.col(REASON_COL).alias("reason"), F.to_json(F.struct(*data)).alias("row")))


def _stage(spark: SparkSession, rows: DataFrame, path: str) -> tuple[int, int]:
    """Write the rows; their number, and that of the rows that break the layout."""
    if REASON_COL not in rows.columns:
        rows = rows.withColumn(REASON_COL, F.lit(""))
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    observed = rows.observe(obs, F.count(F.lit(1)).alias("n"),
                            F.count_if(F.col(REASON_COL) != "").alias("bad"))
    observed.write.mode("errorifexists").parquet(path)
    m = obs.get
    return int(m["n"]), int(m["bad"])


def replace_window(spark: SparkSession, table: str, rows: DataFrame | Callable[[], DataFrame], window: Window,
                   job: str, quarantine_table: str | None = None,
                   scheduler: str | None = None) -> RunResult:
    """Replace the rows of ``window`` in ``table`` with ``rows``.

    ``rows`` must already hold only the window's rows with the table's columns
    (any order) and may carry a ``_reason`` column from
    ``periodica.operators.conformance.violation_reason``. It may be a function
    that makes them: an error there is then a result of the run, like any other,
    and it is called again where another load of the window came first.
    """
    res = RunResult(job=job, window=window, scheduler=scheduler)
    staging = live = None
    try:
        root = table_location(spark, table)
        for _ in range(TRIES):
            seen = sync_windows(spark, table, root).get(window.start, 0)
            made = rows() if callable(rows) else rows
            res.deleted = partition_count(spark, table, window.start)
            staging = f"{root}/{VERSIONS}/{PERIOD_COL}={window.start.isoformat()}/{uuid.uuid4().hex}"
            n, bad = _stage(spark, made, staging)
            if bad:
                res.rejected, res.deleted = bad, 0
                res.status, res.message = STATUS_ERROR, MSG_REJECTED.format(n=bad)
                res.log(res.message)
                if quarantine_table:
                    quarantine_rows(spark.read.parquet(staging), quarantine_table, job, F.lit(window.start))
                    res.quarantine = quarantine_table
                break
            if commit_window(spark, root, window.start, seen, staging):
                live, staging = staging, None     # the staged folder is now the window
                res.inserted = n
                if res.deleted:
                    res.log(MSG_DELETED.format(n=res.deleted))
                res.log(MSG_DONE.format(n=n))
                point_windows(spark, table, {window.start: Version(seen + 1, live)})
                break
            delete_path(spark, staging)
        else:
            raise RuntimeError(MSG_BUSY.format(n=TRIES))
    except Exception as e:  # the status is data in the log, as in the legacy jobs
        if live:        # committed: the next reader points the catalog
            res.log(MSG_FAILED.format(e=e))
        else:
            failed(res, e)
    finally:
        if staging:
            delete_path(spark, staging)
        res.finished = dt.datetime.now()
    return res


def replace_windows(spark: SparkSession, table: str, rows: DataFrame, frequency: str,
                    control: str, job: str, first: dt.date | None = None,
                    last: dt.date | None = None, scheduler: str | None = None,
                    quarantine_table: str | None = None, only: set[dt.date] | None = None,
                    seen: dict[dt.date, int] | None = None) -> list[RunResult]:
    """Replace every window between ``first`` and ``last`` (inclusive period
    starts; all windows of ``rows`` when omitted), or of the set ``only``, in one
    distributed job. ``seen`` holds the versions that ``rows`` was made from, where it
    was made from the table itself.

    Rows are rebalanced by window and written once, partitioned by window, inside
    the table's folder; per-window counts come from one grouped aggregate of what
    was written (one row per window). Windows with violations are left untouched
    and their rows quarantined. Every clean window is then committed by itself, and
    its folder becomes the window: nothing is copied and no live folder is written
    to. A window that another load committed meanwhile ends with status ``Error``.

    Windows of the range or set that exist in the target but have no source rows are
    emptied, so no stale rows survive; without a range nothing outside the rows'
    own windows changes. Violating rows whose control date does not convert
    belong to no window: they are quarantined and counted in one more result,
    whose window is None.
    """
    if REASON_COL not in rows.columns:
        rows = rows.withColumn(REASON_COL, F.lit(""))
    if PERIOD_COL not in rows.columns:
        rows = rows.withColumn(PERIOD_COL, period_start(control, frequency))
    # rows without a window stay only where they break a rule: a control date
    # that does not convert is quarantined and counted, a NULL one is in no window
    rows = rows.where(F.col(PERIOD_COL).isNotNull() | (F.col(REASON_COL) != ""))
    if first is not None:
        rows = rows.where(F.col(PERIOD_COL) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(PERIOD_COL) <= F.lit(last))
    if only is not None:
        rows = rows.where(F.col(PERIOD_COL).isin(list(only)))
    started = dt.datetime.now()
    root = table_location(spark, table)
    seen = sync_windows(spark, table, root) if seen is None else seen
    staging = f"{root}/{VERSIONS}/batch_{uuid.uuid4().hex}"
    live = False        # whether a window of the staged batch has been committed
    try:
        # Cluster rows by window before they are written: AQE's rebalance splits a
        # large window over several tasks and packs small ones together, so each
        # window ends up in a few right-sized files instead of one small file per
        # input task and window.
        rows.hint("rebalance", PERIOD_COL).write.mode("errorifexists").partitionBy(PERIOD_COL).parquet(staging)
        staged = spark.read.schema(f"{PERIOD_COL} DATE, {REASON_COL} STRING").parquet(staging)
        stats = {r[PERIOD_COL]: (int(r["n"]), int(r["bad"])) for r in
                 staged.groupBy(PERIOD_COL).agg(
                     F.count(F.lit(1)).alias("n"),
                     F.count_if(F.col(REASON_COL) != "").alias("bad")).collect()}
        lost = stats.pop(None, (0, 0))[0]
        target = spark.table(table)
        if first is not None:
            target = target.where(F.col(PERIOD_COL) >= F.lit(first))
        if last is not None:
            target = target.where(F.col(PERIOD_COL) <= F.lit(last))
        if only is not None:
            target = target.where(F.col(PERIOD_COL).isin(list(only)))
        elif first is None and last is None:
            # all windows of the rows, and no others: without rows nothing changes
            target = target.where(F.col(PERIOD_COL).isin(list(stats)))
        before = {r[PERIOD_COL]: int(r["n"]) for r in
                  target.groupBy(PERIOD_COL).agg(F.count(F.lit(1)).alias("n")).collect()}
        bad_windows = sorted(p for p, (_, bad) in stats.items() if bad > 0)
        if (bad_windows or lost) and quarantine_table:
            quarantine_rows(spark.read.parquet(staging), quarantine_table, job, F.col(PERIOD_COL))
        made, late = {}, set()
        for p in sorted(set(stats) | set(before)):
            n, bad = stats.get(p, (0, 0))
            if bad:
                continue
            folder = f"{staging}/{PERIOD_COL}={p.isoformat()}" if p in stats else None
            if commit_window(spark, root, p, seen.get(p, 0), folder):
                made[p] = Version(seen.get(p, 0) + 1, folder)
                live = live or folder is not None
            else:
                late.add(p)
        point_windows(spark, table, made)
        for p in [*map(dt.date.isoformat, [*bad_windows, *late]), "__HIVE_DEFAULT_PARTITION__"]:
            delete_path(spark, f"{staging}/{PERIOD_COL}={p}")
        finished = dt.datetime.now()
        out = []
        for p in sorted(set(stats) | set(before)):
            win = window_for(p, frequency)
            n, bad = stats.get(p, (0, 0))
            r = RunResult(job=job, window=win, started=started, finished=finished,
                          scheduler=scheduler)
            if bad or p in late:
                r.status, r.rejected = STATUS_ERROR, bad
                r.message = MSG_REJECTED.format(n=bad) if bad else MSG_BUSY.format(n=1)
                r.log(r.message)
            else:
                r.deleted, r.inserted = before.get(p, 0), n
                if r.deleted:
                    r.log(MSG_DELETED.format(n=r.deleted))
                r.log(MSG_DONE.format(n=n))
            out.append(r)
        if lost:
            r = RunResult(job=job, window=None, started=started, finished=finished, scheduler=scheduler,
                          status=STATUS_ERROR, rejected=lost, message=MSG_NO_WINDOW.format(n=lost))
            r.log(r.message)
            out.append(r)
        return out
    finally:
        if not live:
            delete_path(spark, staging)


def replace_by(spark: SparkSession, table: str, rows: DataFrame, window: Window, delete_on: str, frequency: str,
               control: str, job: str, quarantine_table: str | None = None, scheduler: str | None = None) -> RunResult:
    """A load whose delete and insert go by different columns: the stored rows whose
    ``delete_on`` lies in ``window`` go, whatever window they are stored in, and ``rows``
    are added to the windows of their control date.

    Only the windows that hold rows to delete, or get rows, are written anew; each is
    committed by itself, from the version that was read."""
    res = RunResult(job=job, window=window, scheduler=scheduler)
    try:
        seen = sync_windows(spark, table, table_location(spark, table))
        stored = spark.table(table)
        gone = F.coalesce(in_window(delete_on, window), F.lit(False))
        counts = {r[PERIOD_COL]: int(r["n"]) for r in
                  stored.where(gone).groupBy(PERIOD_COL).agg(F.count(F.lit(1)).alias("n")).collect()}
        if REASON_COL not in rows.columns:
            rows = rows.withColumn(REASON_COL, F.lit(""))
        rows = rows.withColumn(PERIOD_COL, period_start(control, frequency))
        touched = set(counts) | {r[0] for r in rows.select(PERIOD_COL).distinct().collect() if r[0] is not None}
        kept = stored.where(F.col(PERIOD_COL).isin(list(touched)) & ~gone).withColumn(REASON_COL, F.lit(""))
        results = replace_windows(spark, table, kept.unionByName(rows.select(*kept.columns)), frequency, control, job,
                                  quarantine_table=quarantine_table, only=touched, seen=seen)
        failures = [r for r in results if not r.ok]
        res.deleted = sum(counts.values())
        res.inserted = sum(r.inserted - r.deleted for r in results if r.ok) + res.deleted
        if failures:
            res.status, res.message = STATUS_ERROR, failures[0].message
            res.rejected = sum(r.rejected for r in failures)
        for line in ([MSG_DELETED.format(n=res.deleted)] if res.deleted else []) + [res.message or MSG_DONE.format(n=res.inserted)]:
            res.log(line)
        res.finished = dt.datetime.now()
        return res
    except Exception as e:
        return failed(res, e)

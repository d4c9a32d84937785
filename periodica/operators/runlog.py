"""Run log (S15) and the alert content for failed runs.

The log is an append-only table with one row per run. Alerts are a derived
DataFrame (subject, start, end, duration, error, log); sending mail is outside
the engine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.formats import render_ts_120
from periodica.functions.scalar import seconds_between
from periodica.operators.window_sink import STATUS_ERROR, STATUS_OK, RunResult
from periodica.sources.appends import append_run

LOG_SCHEMA = T.StructType([
    T.StructField("FechaEjecucion", T.TimestampNTZType(), False),
    T.StructField("FilasInsertadas", T.LongType(), False),
    T.StructField("EstadoEjecucion", T.StringType(), False),
    T.StructField("MensajeError", T.StringType(), True),
    T.StructField("DetallesLog", T.StringType(), False),
    T.StructField("NombreJob", T.StringType(), False),
    T.StructField("ProgramadorJob", T.StringType(), True),
    T.StructField("FechaFin", T.TimestampNTZType(), True),
    T.StructField("InicioVentana", T.DateType(), True),
])

# Alert texts.
ALERT_SUBJECT = "ALERTA: Error en "
UNKNOWN_JOB = "Job Desconocido"
NO_SCHEDULER = "No especificado"


def log_rows(spark: SparkSession, results: Iterable[RunResult]) -> DataFrame:
    """One-row-per-run DataFrame with the log schema (driver-side values only:
    a handful of scalars per run, never data rows)."""
    rows = [(r.started.replace(microsecond=0), int(r.inserted), r.status,
             None if r.status == STATUS_OK else r.message, r.details, r.job,
             r.scheduler, r.finished.replace(microsecond=0) if r.finished else None,
             r.window.start if r.window else None)
            for r in results]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def log_run(spark: SparkSession, table: str, results: Iterable[RunResult]) -> None:
    """Append to the run-log table (created on first use), in a folder of this call alone,
    so that runs side by side all leave their rows (``sources.appends``)."""
    append_run(spark, table, log_rows(spark, results).coalesce(1))


def alert_rows(log: DataFrame, recipients: str | None, profile: str | None) -> DataFrame:
    """Alert content for failed runs, only when both recipients and a mail
    profile are given (S20). Columns: subject, body, started, finished, seconds."""
    if recipients is None or profile is None:
        return log.limit(0).select(F.lit("").alias("subject"), F.lit("").alias("body"),
                                   F.col("FechaEjecucion").alias("started"),
                                   F.col("FechaFin").alias("finished"),
                                   F.lit(0).cast("long").alias("seconds"),
                                   F.col("InicioVentana").alias("window_start"),
                                   F.col("MensajeError").alias("error"))
    failed = log.where(F.col("EstadoEjecucion") == STATUS_ERROR)
    secs = seconds_between("FechaEjecucion", "FechaFin")
    crlf = F.lit("\r\n")
    body = F.concat(
        F.lit("Error en "), F.col("NombreJob"), crlf,
        F.lit("- Programado por: "), F.coalesce(F.col("ProgramadorJob"), F.lit(NO_SCHEDULER)), crlf,
        F.lit("- Inicio: "), render_ts_120("FechaEjecucion"), crlf,
        F.lit("- Fin: "), render_ts_120("FechaFin"), crlf,
        F.lit("- Duracion: "), secs.cast("string"), F.lit(" segundos"), crlf,
        F.lit("Error: "), F.col("MensajeError"), crlf,
        F.lit("Log: "), F.col("DetallesLog"))
    return failed.select(
        F.concat(F.lit(ALERT_SUBJECT), F.coalesce(F.col("NombreJob"), F.lit(UNKNOWN_JOB))).alias("subject"),
        body.alias("body"),
        F.col("FechaEjecucion").alias("started"), F.col("FechaFin").alias("finished"),
        secs.alias("seconds"), F.col("InicioVentana").alias("window_start"),
        F.col("MensajeError").alias("error"))


__all__ = ["LOG_SCHEMA", "log_rows", "log_run", "alert_rows", "STATUS_OK", "STATUS_ERROR"]

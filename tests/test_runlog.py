"""S15 run log appends, S20 alert body (X-8, X-13, X-18), P6 window agreement."""
import datetime as dt

from periodica.functions.periods import MONTHLY, WEEKLY, window_for
from periodica.operators.frequency import windows_agree
from periodica.operators.runlog import alert_rows, log_rows, log_run
from periodica.operators.window_sink import STATUS_ERROR, RunResult
from periodica.plans import testdata as td


def _run(status, msg=None):
    r = RunResult(job="[212_SECCION_5_LINEAS_CRE]", window=window_for(dt.date(2026, 1, 31), MONTHLY),
                  started=dt.datetime(2026, 2, 1, 6, 0, 0, 900000), scheduler=None)
    r.finished = dt.datetime(2026, 2, 1, 6, 0, 42, 100000)
    r.status, r.message = status, msg
    r.log("Registros eliminados: 3")
    return r


def test_log_appends_and_alert_body(spark, lake):
    t = lake.fq("silver", "log_silver_diario")
    log_run(spark, t, [_run("Exitoso")])
    log_run(spark, t, [_run(STATUS_ERROR, "boom")])
    log = spark.table(t)
    assert log.count() == 2
    ok = log.where("EstadoEjecucion = 'Exitoso'").first()
    assert ok["MensajeError"] is None and ok["InicioVentana"] == dt.date(2026, 1, 1)
    alerts = alert_rows(log, "ops@example.org", "perfil").collect()
    assert len(alerts) == 1
    body = alerts[0]["body"].split("\r\n")
    assert body[0] == "Error en [212_SECCION_5_LINEAS_CRE]"
    assert body[1] == "- Programado por: No especificado"
    assert body[2] == "- Inicio: 2026-02-01 06:00:00" and body[3] == "- Fin: 2026-02-01 06:00:42"
    assert body[4] == "- Duracion: 42 segundos" and body[5] == "Error: boom"
    assert body[6].startswith("Log: Registros eliminados: 3")
    assert alert_rows(log, "ops@example.org", None).count() == 0


def test_window_agreement_rule():
    spec = td.orders_spec(MONTHLY)
    assert windows_agree(spec, spec)
    assert not windows_agree(spec, spec.with_version(frequency=WEEKLY))

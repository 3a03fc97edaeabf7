"""Control of runs: retries, guards, states, conflicts."""

import pytest
from pyspark.sql import functions as F

from cordal.functions.values import duration_text, html_escaped, script_json
from cordal.operators import quarantine, reconcile
from cordal.plans.service import Memo, RunConflict, RunService, TransientExhausted, once, retried


def test_retries():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("net")
        return "done"

    assert retried(flaky, "salida", sleep=waits.append) == "done" and waits == [5, 30]
    waits.clear()
    with pytest.raises(TransientExhausted) as caught:
        retried(lambda: open("/nonexistent/x"), "salida", sleep=waits.append)
    assert waits == [5, 30, 180] and caught.value.etapa == "salida" and caught.value.codigo == "error_transitorio_agotado"
    with pytest.raises(ValueError):
        retried(lambda: int("x"), "salida", sleep=waits.append)
    assert len(waits) == 3


def test_guards():
    rows = once(iter([1, 2]))
    assert list(rows) == [1, 2]
    with pytest.raises(RuntimeError):
        list(rows)
    now, made = [0.0], []
    memo = Memo(lambda: made.append(1) or len(made), 1.0, lambda: now[0])
    assert (memo(), memo()) == (1, 1)
    now[0] = 1.0
    assert memo() == 2


def test_run_service(spark, tmp_path):
    service = RunService(spark, str(tmp_path / "log"))
    service.create("r1")
    with pytest.raises(RunConflict):
        service.create("r2")
    for version, state in enumerate(["inventariando", "procesando", "completada_con_cuarentena"], 1):
        service.advance("r1", state, version)
    with pytest.raises(RunConflict):
        service.advance("r1", "publicando", 4)
    with pytest.raises(KeyError):
        service.query("r9")
    retryable = next(iter(quarantine.RETRYABLE))
    held = spark.createDataFrame([("a", retryable), ("b", "parseo_incompleto")], "documento string, codigo string")
    files = spark.createDataFrame([("a", "/in/a.pdf")], "documento string, ruta string")
    with pytest.raises(RunConflict):
        service.retry("r1", held, files.limit(0), "documento")
    assert [r.ruta for r in service.retry("r1", held, files, "documento").collect()] == ["/in/a.pdf"]
    assert service.query("r1") == ("procesando", 5)
    with pytest.raises(RunConflict):
        service.retry("r1", held, files, "documento")
    service.advance("r1", "completada", 5)
    service.create("r2")
    assert [(r.corrida, r.estado) for r in service.states().collect()] == [("r1", "completada"), ("r2", "creada")]


def test_log_and_page_texts(spark):
    event = F.create_map(F.lit("id_documento"), F.lit("DNI 12.345.678"), F.lit("nombre"), F.lit("Ana"), F.lit("codigo"), F.lit("x"))
    row = spark.range(1).select(
        quarantine.safe_event(event), html_escaped(F.lit("<a b=\"c\">&'")), script_json(F.lit('{"a":"</script>&"}')),
        duration_text(F.lit(59)), duration_text(F.lit(3700)), duration_text(F.lit(None).cast("long")),
        reconcile.permitted_text(F.lit(" PID /  Name Mismatch"), "ecg"), reconcile.permitted_text(F.lit("PRUEBA RESULTADO UNIDADES"), "laboratorio"),
        reconcile.permitted_text(F.lit("Urea 30"), "laboratorio"), reconcile.permitted_text(F.lit("Diagnostico por imagenes"), "ecocardiograma"),
    ).first()
    assert row[0] == {"id_documento": "DNI [REDACTADO]", "codigo": "x"}
    assert row[1] == "&lt;a b=&quot;c&quot;&gt;&amp;&#x27;" and "<" not in row[2] and row[2].startswith('{"a":"' + chr(92) + 'u003c/script')
    assert tuple(row[3:6]) == ("0 min", "1 h 1 min", "0 min") and tuple(row[6:]) == (True, True, False, True)

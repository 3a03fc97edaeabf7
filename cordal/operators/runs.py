"""Run control read models: state machines, latest state, resumable documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordal.operators.ordered import with_previous

#: Allowed transitions of a run.
RUN_TRANSITIONS = {
    "creada": ["inventariando", "fallida"],
    "inventariando": ["procesando", "fallida"],
    "procesando": ["reconciliando", "completada", "completada_con_cuarentena", "fallida"],
    "reconciliando": ["publicando", "completada_con_cuarentena", "fallida"],
    "publicando": ["completada", "completada_con_cuarentena", "fallida"],
    "completada": [],
    "completada_con_cuarentena": ["procesando"],
    "fallida": ["procesando"],
}
#: States in which a document needs no further work.
DOCUMENT_FINAL = ["aprobado", "cuarentena", "error_final"]


def violations(
    log: DataFrame, key: str, order: list[str], state: str, allowed: dict[str, list[str]], slot: Column | None = None
) -> DataFrame:
    """Log rows whose state may not follow the one before.

    ``slot`` never falls in ``order``; it spreads the log of a large key (see ``ordered``).
    """
    rows = with_previous(log, key, order, state, F.lit(0) if slot is None else slot).drop("_slot", "_primera")
    bad = F.lit(True)
    for before, after in allowed.items():
        bad = F.when(F.col("anterior") == before, ~F.col(state).isin(after) if after else F.lit(True)).otherwise(bad)
    return rows.where(F.col("anterior").isNotNull() & bad)


def latest(log: DataFrame, key: str, version: list[str], state: str) -> DataFrame:
    """Last state per key of an append-only log, with map-side combine."""
    return log.groupBy(key).agg(F.max_by(state, F.struct(*version)).alias("estado"), F.count("*").alias("cambios"))


def open_runs(runs: DataFrame, state: str, allowed: dict[str, list[str]] | None = None) -> DataFrame:
    """Runs whose state is not final."""
    final = ["completada", "completada_con_cuarentena", "fallida"] if allowed is None else [k for k, v in allowed.items() if not v]
    return runs.where(~F.col(state).isin(final))


def resumable(documents: DataFrame, state: str) -> DataFrame:
    """Documents with work left."""
    return documents.where(~F.col(state).isin(DOCUMENT_FINAL))

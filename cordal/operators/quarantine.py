"""Quarantine: idempotent registration, report, retry plan, log projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cordal.functions.masking import redact_ids

#: Codes that a retry without changes may cure.
RETRYABLE = ["clave_pii_no_resuelta", "error_transitorio_agotado", "episodio_incompleto", "proceso_interrumpido"]
#: Code to the action somebody has to take.
ACTIONS = {
    "episodio_incompleto": "pedir_material",
    "episodio_ambiguo": "pedir_material",
    "tipo_no_reconocido": "revisar_el_programa",
    "parseo_incompleto": "revisar_el_programa",
    "evidencia_ausente": "revisar_el_programa",
    "evidencia_ambigua": "revisar_el_programa",
    "valor_discrepante": "revisar_el_programa",
    "cobertura_incompleta": "revisar_el_programa",
    "cobertura_ambigua": "revisar_el_programa",
    "artefacto_sobretamano": "revisar_el_programa",
    "error_transitorio_agotado": "revisar_el_programa",
    "pdf_ilegible": "revisar_el_programa",
    "sin_capa_de_texto": "necesita_ocr",
    "proceso_interrumpido": "revisar_el_programa",
    "clave_pii_no_resuelta": "revisar_a_mano",
    "clave_pii_ambigua": "revisar_a_mano",
}
UNCLASSIFIED = "sin_clasificar"
#: Keys a log line may carry.
LOG_KEYS = ["id_documento", "etapa", "codigo", "tipo_documento", "corrida_id"]


def is_retryable(code: Column) -> Column:
    return code.isin(RETRYABLE)


def first_failure(new: DataFrame, existing: DataFrame | None, run: str, doc: str, order: list[str]) -> DataFrame:
    """Rows to insert: the first failure per (run, document) that is not there yet.

    A null run id or document never collides with anything (SQL unique semantics).
    """
    keyed = new.where(F.col(run).isNotNull() & F.col(doc).isNotNull())
    free = new.where(F.col(run).isNull() | F.col(doc).isNull())
    one = keyed.withColumn("_n", F.row_number().over(W.partitionBy(run, doc).orderBy(*order))).where("_n = 1").drop("_n")
    if existing is not None:
        one = one.join(existing.select(run, doc), [run, doc], "left_anti")
    return one.unionByName(free)


def stamped(rows: DataFrame, run_id: str) -> DataFrame:
    """Rows with the id of the run that registers them."""
    return rows.withColumn("corrida_id", F.lit(run_id))


def report(rows: DataFrame, code: str = "codigo") -> DataFrame:
    """Rows with ``accion``; codes without an action are kept as unclassified."""
    action = F.lit(None).cast("string")
    for name, value in ACTIONS.items():
        action = F.when(F.col(code) == name, F.lit(value)).otherwise(action)
    return rows.withColumn("accion", F.coalesce(action, F.lit(UNCLASSIFIED)))


def location(field: Column, page: Column) -> Column:
    """``campo, página n`` of what is known."""
    return F.concat_ws(", ", field, F.when(page.isNotNull(), F.concat(F.lit("página "), page.cast("string"))))


def retry_plan(quarantined: DataFrame, inventory: DataFrame, key: str, code: str = "codigo") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(to retry with their address, retryable without inventory: must be empty, discarded by code)."""
    wanted = quarantined.where(is_retryable(F.col(code)))
    return (
        wanted.join(inventory, key),
        wanted.join(inventory, key, "left_anti"),
        quarantined.where(~is_retryable(F.col(code))).groupBy(code).agg(F.count("*").alias("descartados")),
    )


def log_event(event: Column, keys: list[str] | None = None) -> Column:
    """The whitelisted entries of an event map."""
    return F.map_filter(event, lambda k, v: k.isin(keys or LOG_KEYS))


def safe_event(event: Column, keys: list[str] | None = None) -> Column:
    """The whitelisted entries with ids inside their values redacted."""
    return F.transform_values(log_event(event, keys), lambda _, v: redact_ids(v))

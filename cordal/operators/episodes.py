"""Fixed-anchor episodes and their completeness gate.

An episode starts at an anchor date and takes every document up to ``window_days``
later; the anchor never moves, so chains are cut. That is a fold over the
distinct dates of a patient. Dates are made distinct (with map-side combine)
before they are gathered, so a patient with a third of all documents
contributes at most one element per calendar day; the documents are joined back
on (patient, date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_DAYS = 7
#: Motive of the gate to quarantine code.
GATE_CODES = {"asociacion_ambigua": "episodio_ambiguo", "estudios_faltantes": "episodio_incompleto"}


def _anchors(dates: Column, window_days: int) -> Column:
    """(fecha, ancla) of a sorted array of distinct dates."""
    empty = F.array().cast("array<struct<fecha:date,ancla:date>>")
    return F.aggregate(
        dates,
        empty,
        lambda acc, d: F.concat(
            acc,
            F.array(
                F.struct(
                    d.alias("fecha"),
                    F.when(
                        (F.size(acc) > 0) & (F.datediff(d, F.element_at(acc, -1)["ancla"]) <= window_days),
                        F.element_at(acc, -1)["ancla"],
                    )
                    .otherwise(d)
                    .alias("ancla"),
                )
            ),
        ),
    )


def anchor_dates(docs: DataFrame, patient: str, date: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """(paciente, fecha, ancla): the anchor of every patient and day."""
    days = docs.where(F.col(patient).isNotNull() & F.col(date).isNotNull()).select(
        F.col(patient).alias("paciente"), F.to_date(date).alias("fecha")
    )
    sorted_days = days.groupBy("paciente").agg(F.array_sort(F.collect_set("fecha")).alias("dias"))
    return sorted_days.select("paciente", F.inline(_anchors(F.col("dias"), window_days)))


def anchor_episodes(docs: DataFrame, patient: str, date: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """``docs`` with ``ancla``; rows without patient or date belong to no episode."""
    anchors = anchor_dates(docs, patient, date, window_days)
    keyed = docs.withColumn("_dia", F.to_date(date))
    return keyed.join(
        anchors, (keyed[patient] == anchors["paciente"]) & (keyed["_dia"] == anchors["fecha"])
    ).drop("_dia", "paciente", "fecha" if date != "fecha" else "_")


def gate(
    linked: DataFrame, patient: str, kind: str, required: list[str], closed: bool = True, anchor: str = "ancla"
) -> DataFrame:
    """One row per episode: documentos, tipos, faltantes, motivo, estado.

    Duplicate types make an episode ambiguous (checked first); a missing required
    type makes it incomplete, or pending while the run is open.
    """
    need = F.array(*[F.lit(r) for r in sorted(required)])
    rows = linked.groupBy(patient, anchor).agg(
        F.count("*").alias("documentos"),
        F.count_distinct(kind).alias("tipos"),
        F.array_sort(F.array_except(need, F.collect_set(kind))).alias("faltan"),
    )
    ambiguous = F.col("documentos") > F.col("tipos")
    missing = F.size("faltan") > 0
    motive = F.when(ambiguous, "asociacion_ambigua").when(missing & F.lit(closed), "estudios_faltantes")
    state = F.when(ambiguous, "cuarentena").when(missing, "cuarentena" if closed else "pendiente").otherwise("aprobado")
    code = F.lit(None).cast("string")
    for name, value in GATE_CODES.items():
        code = F.when(motive == name, F.lit(value)).otherwise(code)
    return rows.select(
        patient, anchor, "documentos", "tipos", F.array_join("faltan", ",").alias("faltantes"),
        motive.alias("motivo"), code.alias("codigo"), state.alias("estado"),
    )


def presence(linked: DataFrame, patient: str, kind: str, kinds: list[str], anchor: str = "ancla") -> DataFrame:
    """Per episode one flag per type and ``completo``."""
    flags = [F.bool_or(F.col(kind) == k).alias(f"tiene_{k}") for k in kinds]
    out = linked.groupBy(patient, anchor).agg(*flags)
    both = F.lit(True)
    for k in kinds:
        both = both & F.col(f"tiene_{k}")
    return out.withColumn("completo", both)


def unaccounted(docs: DataFrame, approved: DataFrame, quarantined: DataFrame, key: str) -> DataFrame:
    """Documents that are neither approved nor in quarantine: must be empty."""
    seen = approved.select(key).unionByName(quarantined.select(key))
    return docs.select(key).join(seen, key, "left_anti")

"""Pair each left record with the right record of the same entity nearest in time.

Right timestamps become disjoint intervals: from the midpoint to the previous
right record to the midpoint to the next one, both cut at the tolerance. A left
timestamp lies in at most one interval of its entity, the one of its nearest
right record. The index is partitioned by (entity, time slot): right records
are repeated only into the neighbouring slot they can reach within the
tolerance, so an entity with a third of all rows is spread over its time slots
and no entity is ever sorted in one task. Looking up an interval is a running
"last interval start" over the merged order, linear in the rows of a slot.

Defined results
---------------
* null entity or null time on either side: that row is not paired.
* distances up to and including the tolerance count; on equal distance the
  earlier right record wins, then the smaller right id.
* repeated rows (same id, entity and time) count once; a right record may serve
  several left ones; a left id with two different times is paired for each.
* empty tables: no rows. Further columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOLERANCE_S = 5400
SLOT_S = 86_400


def second_of_day(text: Column) -> Column:
    """Seconds after midnight of an hour typed as ``8:05``, ``08.05``, ``08h05``,
    ``08:05 hs``, ``08:05:09`` or ``01:05 p.m.``; null when it is none of them."""
    pattern = r"(?i)^\s*([0-9]{1,2})\s*[:.h]\s*([0-9]{2})(?:\s*[:.m]\s*([0-9]{2}))?\s*(?:hs?\.?|horas?)?\s*([ap])?\.?\s*(?:m\.?)?\s*$"
    typed = F.when(text.rlike(pattern), F.split(F.regexp_replace(text, pattern, "$1:$2:$3:$4"), ":"))

    def seconds(part: Column) -> Column:
        hour, minute = part[0].cast("int"), part[1].cast("int")
        second = F.coalesce(F.nullif(part[2], F.lit("")).cast("int"), F.lit(0))
        half = F.lower(part[3])
        hour = F.when((half == "p") & (hour < 12), hour + 12).when((half == "a") & (hour == 12), 0).otherwise(hour)
        return F.when((hour < 24) & (minute < 60) & (second < 60), hour * 3600 + minute * 60 + second)

    return F.transform(F.array(typed), lambda part: F.when(part.isNotNull(), seconds(part)))[0]  # parsed once


def instant(date: Column, hour: Column) -> Column:
    """Seconds since 1970-01-01 of a date and a typed hour; null if either is missing."""
    return F.datediff(date, F.lit("1970-01-01").cast("date")).cast("long") * 86_400 + second_of_day(hour)


def nearest_in_time(
    left: DataFrame, right: DataFrame, tolerance: int = TOLERANCE_S, slot: int = SLOT_S
) -> DataFrame:
    """id_izq, id_der, distancia for ``left`` and ``right`` of (entidad, id, t).

    ``t`` is in whole seconds; ``slot`` (seconds) must not be below ``tolerance``.
    """
    if slot < tolerance:
        raise ValueError("slot must be at least the tolerance")
    t, cell = F.col("t"), lambda c: F.floor(c / F.lit(slot))
    usable = F.col("entidad").isNotNull() & t.isNotNull() & F.col("id").isNotNull()
    by = W.partitionBy("entidad", "franja")
    index = (
        right.where(usable)
        .select("entidad", "id", "t", F.explode(F.sequence(cell(t - tolerance), cell(t + tolerance))).alias("franja"))
        .repartition("entidad", "franja")
        .withColumn("_n", F.row_number().over(W.partitionBy("entidad", "franja", "t").orderBy("id")))
        .where("_n = 1")
        .withColumn("_antes", F.lag("t").over(by.orderBy("t")))
        .withColumn("_luego", F.lead("t").over(by.orderBy("t")))
    )
    # doubled seconds keep midpoints whole; the earlier record owns the midpoint
    start = F.greatest(2 * (t - tolerance), F.col("_antes") + t + 1)
    end = F.least(2 * (t + tolerance), F.col("_luego") + t)
    starts = index.select(
        "entidad", "franja", start.alias("clave"), F.lit(0).alias("orden"),
        F.lit(None).cast(left.schema["id"].dataType).alias("id_izq"),
        F.struct(end.alias("fin"), F.col("id").alias("id_der"), F.col("t").alias("t_der")).alias("intervalo"),
    )
    points = left.where(usable).select(
        "entidad", cell(t).alias("franja"), (2 * t).alias("clave"), F.lit(1).alias("orden"),
        F.col("id").alias("id_izq"), F.lit(None).cast(starts.schema["intervalo"].dataType).alias("intervalo"),
    )
    running = by.orderBy("clave", "orden").rowsBetween(W.unboundedPreceding, W.currentRow)
    merged = starts.unionByName(points).withColumn("i", F.last("intervalo", ignorenulls=True).over(running))
    return (
        merged.where((F.col("orden") == 1) & (F.col("clave") <= F.col("i.fin")))
        .select(
            "id_izq",
            F.col("i.id_der").alias("id_der"),
            (F.abs(F.col("clave") - 2 * F.col("i.t_der")) / 2).cast("long").alias("distancia"),
        )
        .distinct()
    )


def ecg_with_laboratory(ecg: DataFrame, studies: DataFrame, tolerance: int = TOLERANCE_S) -> DataFrame:
    """id_ecg, id_laboratorio, distancia: each ECG with its nearest laboratory study."""

    def timed(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("id_paciente").alias("entidad"),
            F.col("id_estudio").alias("id"),
            instant(F.col("fecha_estudio"), F.col("hora_estudio")).alias("t"),
        )

    pairs = nearest_in_time(timed(ecg), timed(studies.where(F.col("tipo_documento") == "laboratorio")), tolerance)
    return pairs.toDF("id_ecg", "id_laboratorio", "distancia")

"""Run read models: funnel, estimate, histograms, activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Stages in the order of execution.
STAGES = ["ingesta", "despacho", "extraccion", "parseo", "reconciliacion", "coordinacion", "pseudonimizacion", "salida"]
MIN_FINISHED = 200
RECENT_S = 300
ABANDONED_MIN = 15


def totals(entered: DataFrame, published: DataFrame, losses: DataFrame) -> DataFrame:
    """One row: entraron, publicados, apartados, con_desenlace, residuo (signed), cierra."""
    n = entered.agg(F.count("*").alias("entraron"))
    p = published.agg(F.count("*").alias("publicados"))
    a = losses.agg(F.count("*").alias("apartados"))
    out = n.join(p).join(a)  # three one-row aggregates
    out = out.withColumn("con_desenlace", F.col("publicados") + F.col("apartados"))
    out = out.withColumn("residuo", F.col("entraron") - F.col("con_desenlace"))
    return out.withColumn("cierra", F.col("residuo") >= 0)


def by_stage(published: DataFrame, losses: DataFrame, stage: str) -> DataFrame:
    """Per stage in order: perdidas and llegaron (reached it), from a fixed stage list.

    Losses at unknown stages count in the total but not in the breakdown.
    """
    spark = losses.sparkSession
    order = F.broadcast(spark.createDataFrame([(s, i) for i, s in enumerate(STAGES)], "etapa string, orden int"))
    lost = losses.groupBy(F.col(stage).alias("etapa")).agg(F.count("*").alias("perdidas"))
    ended = published.agg(F.count("*").alias("p")).join(losses.agg(F.count("*").alias("a")))
    ended = ended.select((F.col("p") + F.col("a")).alias("con_desenlace"))
    rows = order.join(lost, "etapa", "left").withColumn("perdidas", F.coalesce("perdidas", F.lit(0)))
    before = F.coalesce(F.sum("perdidas").over(W.orderBy("orden").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_antes", before).join(ended).select(
        "orden", "etapa", (F.col("con_desenlace") - F.col("_antes")).alias("llegaron"), "perdidas"
    )


def rollup(losses: DataFrame, stage: str, code: str) -> DataFrame:
    """Losses by stage and code with subtotals and total in one pass."""
    return losses.rollup(stage, code).agg(F.count("*").alias("perdidas"))


def estimate(entered: Column, finished: Column, recent: Column, elapsed_s: Column) -> Column:
    """struct(situacion, minimo_s, maximo_s): the remaining time as an interval."""
    remaining = entered - finished
    window_rate = recent / F.lit(float(RECENT_S))
    wall_rate = finished / elapsed_s
    state = (
        F.when((finished < MIN_FINISHED) | (entered == 0), "midiendo")
        .when(remaining < 0, "descuadre")
        .when(remaining == 0, "disponible")
        .when(recent == 0, "sin_avance")
        .otherwise("disponible")
    )
    a, b = remaining / window_rate, remaining / wall_rate
    known = (state == "disponible") & (remaining > 0)
    zero = (state == "disponible") & (remaining == 0)
    return F.struct(
        state.alias("situacion"),
        F.when(known, F.bround(F.least(a, b), 2)).when(zero, F.lit(0.0)).alias("minimo_s"),
        F.when(known, F.bround(F.greatest(a, b), 2)).when(zero, F.lit(0.0)).alias("maximo_s"),
    )


def march(residue: Column, recent: Column) -> Column:
    """descuadre, completa, en_vuelo or sin_avance."""
    return (
        F.when(residue < 0, "descuadre").when(residue == 0, "completa").when(recent > 0, "en_vuelo").otherwise("sin_avance")
    )


def missing_fields(studies: DataFrame, complete: str, fields: str) -> DataFrame:
    """How often each field is missing in studies that are known to be incomplete (A10)."""
    return (
        studies.where(~F.col(complete))
        .select(F.explode(fields).alias("campo"))
        .groupBy("campo")
        .agg(F.count("*").alias("veces"))
    )


def last_activity(*moments: Column) -> Column:
    """Latest of nullable moments."""
    return F.greatest(*moments)


def abandoned(runs: DataFrame, last: str, now: Column, minutes: int = ABANDONED_MIN) -> DataFrame:
    """Runs without evidence for more than ``minutes``."""
    return runs.where(F.col(last).isNull() | (F.col(last) < now - F.make_dt_interval(mins=F.lit(minutes))))

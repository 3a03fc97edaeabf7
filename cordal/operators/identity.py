"""Identity bridge with permanent ambiguity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def build_bridge(pairs: DataFrame, alt: str, pid: str, previous: DataFrame | None = None) -> DataFrame:
    """(alt, id_paciente, ambiguo): one distinct id resolves, several are ambiguous for good.

    ``previous`` is an earlier bridge; ambiguity is monotone, so it is united with
    the new pairs and never overwritten. Aggregates combine before the shuffle.
    """
    rows = pairs.where(F.col(alt).isNotNull() & F.col(pid).isNotNull()).select(
        F.col(alt).alias("alt"), F.col(pid).alias("pid"), F.lit(False).alias("antes")
    )
    if previous is not None:
        rows = rows.unionByName(
            previous.select("alt", F.col("id_paciente").alias("pid"), F.col("ambiguo").alias("antes"))
        )
    bridge = rows.groupBy("alt").agg(F.min("pid").alias("a"), F.max("pid").alias("b"), F.bool_or("antes").alias("antes"))
    ambiguous = F.col("antes") | (F.coalesce(F.col("a") != F.col("b"), F.lit(False)))
    return bridge.select("alt", F.when(~ambiguous, F.col("a")).alias("id_paciente"), ambiguous.alias("ambiguo"))


def resolve(docs: DataFrame, bridge: DataFrame, alt: str, direct: str) -> DataFrame:
    """``docs`` with ``resuelto`` and ``codigo``: the direct id, else the bridge's."""
    b = bridge.select(F.col("alt").alias("_alt"), F.col("id_paciente").alias("_pid"), F.col("ambiguo").alias("_amb"))
    code = (
        F.when(F.col(direct).isNotNull() | F.col("_pid").isNotNull(), F.lit(None).cast("string"))
        .when(F.col("_amb"), F.lit("clave_pii_ambigua"))
        .otherwise(F.lit("clave_pii_no_resuelta"))
    )
    return (
        docs.join(b, docs[alt] == b["_alt"], "left")
        .withColumn("resuelto", F.coalesce(F.col(direct), F.col("_pid")))
        .withColumn("codigo", code)
        .drop("_alt", "_pid", "_amb")
    )


def resolve_in_order(
    docs: DataFrame, alt: str, direct: str, order: list[str], key: str, slot: Column | None = None
) -> DataFrame:
    """Strict mode: a document sees only the pairs registered before it.

    A running minimum and maximum of the registered ids tells none, one or several.
    They run inside (alternative key, slot) and over one row per slot; ``slot``
    never falls in ``order``, so a key with many documents is spread over it.
    """
    rows = docs.withColumn("_slot", F.lit(0) if slot is None else slot)
    before = W.partitionBy(alt, "_slot").orderBy(*order, key).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_a", F.min(direct).over(before)).withColumn("_b", F.max(direct).over(before))
    ends = docs.withColumn("_slot", F.lit(0) if slot is None else slot).groupBy(alt, "_slot")
    ends = ends.agg(F.min(direct).alias("_lo"), F.max(direct).alias("_hi"))
    earlier = W.partitionBy(alt).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(
        F.col(alt).alias("_alt"), F.col("_slot").alias("_s"), F.min("_lo").over(earlier).alias("_lo"), F.max("_hi").over(earlier).alias("_hi")
    )
    rows = rows.join(ends, rows[alt].eqNullSafe(ends["_alt"]) & rows["_slot"].eqNullSafe(ends["_s"]))
    low, high = F.least("_a", "_lo"), F.greatest("_b", "_hi")
    known = F.col(alt).isNotNull() & low.isNotNull()
    return (
        rows.withColumn("resuelto", F.coalesce(F.col(direct), F.when(known & (low == high), low)))
        .withColumn(
            "codigo",
            F.when(F.col("resuelto").isNotNull(), F.lit(None).cast("string"))
            .when(known, F.lit("clave_pii_ambigua"))
            .otherwise(F.lit("clave_pii_no_resuelta")),
        )
        .drop("_a", "_b", "_lo", "_hi", "_alt", "_s", "_slot")
    )

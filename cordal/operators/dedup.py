"""Scans of delivered files: content dedup, adjacent groups, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordal.operators.ordered import running_sum, with_previous

MAX_BYTES = 50 * 1024 * 1024
ROOT_GROUP = "__raiz__"


def first_of_content(df: DataFrame, content: Column, order: list[str]) -> DataFrame:
    """``df`` with ``huella`` and ``es_copia``: the first row in ``order`` of a content is kept.

    The first row per content is a minimum of a struct with map-side combine, so
    a content repeated in a third of the rows is reduced before the shuffle.
    """
    rows = df.withColumn("huella", F.sha2(content, 256))
    first = rows.groupBy("huella").agg(F.min(F.struct(*order)).alias("_primero"))
    return rows.join(first, "huella").withColumn("es_copia", F.struct(*order) != F.col("_primero")).drop("_primero")


def incomplete_groups(deduped: DataFrame, group: str) -> DataFrame:
    """Per group: rows delivered, kept and lost to copies that live in another place."""
    return deduped.groupBy(group).agg(
        F.count("*").alias("entregados"),
        F.count_if(~F.col("es_copia")).alias("conservados"),
        F.count_if(F.col("es_copia")).alias("copias"),
    )


def adjacent_groups(df: DataFrame, partition: str, order: list[str], value: str, slot: Column | None = None) -> DataFrame:
    """Run lengths: ``tramo`` numbers the runs of equal neighbouring values.

    ``slot`` never falls in ``order``; it spreads a large partition (see ``ordered``).
    """
    rows = with_previous(df, partition, order, value, F.lit(0) if slot is None else slot, "_antes")
    change = (~F.col("_primera") & ~F.col(value).eqNullSafe(F.col("_antes"))).cast("long")
    out = running_sum(rows.withColumn("_cambio", change), partition, order, "_cambio", "tramo")
    return out.drop("_antes", "_primera", "_cambio", "_slot")


def route(files: DataFrame, extensions: list[str], cap: int = MAX_BYTES) -> DataFrame:
    """``files`` (path, length) with ``codigo``: unsupported format first, then size.

    Equal to the cap passes; hidden files are dropped, as in a scan (S01).
    """
    name = F.substring_index("path", "/", -1)
    pattern = r"(?i)\.(" + "|".join(extensions) + ")$"
    return files.where(~name.startswith(".")).withColumn(
        "codigo",
        F.when(~name.rlike(pattern), "formato_no_soportado").when(F.col("length") > cap, "artefacto_sobretamano"),
    )


def folder_group(relative: Column) -> Column:
    """First folder below the root, or the root's own group."""
    return F.when(relative.contains("/"), F.substring_index(relative, "/", 1)).otherwise(F.lit(ROOT_GROUP))


def inside_root(path: Column, root: str) -> Column:
    """Whether a normalised path lies below the root."""
    clean = root.rstrip("/") + "/"
    return path.startswith(clean) & ~path.rlike(r"(^|/)\.\.(/|$)")

"""Two-way reconciliation of extracted values with their source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def occurrences(page: Column, value: Column) -> Column:
    """Non-overlapping occurrences of a value on a page, both normalised."""
    return F.when(
        F.length(value) > 0,
        ((F.length(page) - F.length(F.replace(page, value, F.lit("")))) / F.length(value)).cast("int"),
    )


def evidence_code(page: Column, value: Column, valid_association: Column | None = None) -> Column:
    """Null if the value is proven, else the failure code.

    Exactly one occurrence proves it; none is a discrepancy (absent evidence when
    the page has no digit at all), several are ambiguous. A structural association,
    where known, waives the count or fails outright.
    """
    n = F.coalesce(occurrences(page, value), F.lit(0))
    counted = (
        F.when(page.isNull() | ~page.rlike("[0-9]"), F.lit("evidencia_ausente"))
        .when(n == 0, F.lit("valor_discrepante"))
        .when(n > 1, F.lit("evidencia_ambigua"))
    )
    if valid_association is None:
        return counted
    return F.when(valid_association.isNull(), counted).when(~valid_association, F.lit("valor_discrepante"))


def coverage(inventory: DataFrame, references: DataFrame, keys: list[str], page: str) -> DataFrame:
    """Full outer join of findings and references on ``keys``, one row per key.

    ``codigo``: duplicate key on either side first, then a reference without
    finding or on another page; a finding without reference is only
    ``campo_no_extraido``. Both sides are reduced to one row per key before the join.
    """
    inv = inventory.groupBy(*keys).agg(F.count("*").alias("n_inv"), F.min(page).alias("pagina_inv"))
    ref = references.groupBy(*keys).agg(F.count("*").alias("n_ref"), F.min(page).alias("pagina_ref"))
    code = (
        F.when((F.col("n_inv") > 1) | (F.col("n_ref") > 1), "cobertura_ambigua")
        .when(F.col("n_inv").isNull() | (F.col("pagina_inv") != F.col("pagina_ref")), "cobertura_incompleta")
        .when(F.col("n_ref").isNull(), "campo_no_extraido")
    )
    return inv.join(ref, keys, "full_outer").select(
        *keys, F.coalesce("n_inv", F.lit(0)).alias("n_inv"), F.coalesce("n_ref", F.lit(0)).alias("n_ref"),
        F.coalesce("pagina_inv", "pagina_ref").alias("pagina"), code.alias("codigo"),
    )


def align_rows(left: DataFrame, right: DataFrame, doc: str, position: str, columns: list[str]) -> DataFrame:
    """Positional comparison of two row lists per document.

    One row per document: rows on both sides, differing cells, rows missing on
    either side, and the code that follows.
    """
    a = left.select(doc, position, F.struct(*columns).alias("a"))
    b = right.select(doc, position, F.struct(*columns).alias("b"))
    differing = sum((F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), 1).otherwise(0) for c in columns), F.lit(0))
    both = a.join(b, [doc, position], "full_outer").withColumn("_a", F.col("a").isNotNull()).withColumn("_b", F.col("b").isNotNull())
    out = both.groupBy(doc).agg(
        F.count_if(F.col("_a") & F.col("_b")).alias("pareadas"),
        F.count_if(F.col("_a") & ~F.col("_b")).alias("solo_fuente"),
        F.count_if(~F.col("_a") & F.col("_b")).alias("solo_modelo"),
        F.sum(F.when(F.col("_a") & F.col("_b"), differing).otherwise(0)).alias("celdas_distintas"),
    )
    return out.withColumn(
        "codigo",
        F.when(F.col("solo_modelo") > 0, "cobertura_incompleta").when(F.col("celdas_distintas") > 0, "valor_discrepante"),
    )

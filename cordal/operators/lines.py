"""Operators over the ordered lines of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cordal.functions.grammar import NUMBER, only, optional

#: What a neighbour of a label may be: one number, or one or two with a slash between.
SINGLE_VALUE = only(NUMBER)
WINDOW_VALUE = only(NUMBER, optional("/" + NUMBER))
#: Order in which neighbours of a label are tried.
OFFSETS = (-1, 1, -2, 2, -3, 3)


def numbered_lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, linea, texto): one row per line, numbered from 0."""
    return df.select(F.col(doc), F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("linea", "texto"))


def carry_forward(lines: DataFrame, doc: str, order: list[str], header: Column, name: str = "seccion") -> DataFrame:
    """The last header seen, over lines and pages of a document."""
    w = W.partitionBy(doc).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return lines.withColumn(name, F.last(header, ignorenulls=True).over(w))


def segments(lines: DataFrame, doc: str, order: list[str], header: Column) -> DataFrame:
    """``segmento``: how many headers came up to each line."""
    w = W.partitionBy(doc).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return lines.withColumn("segmento", F.sum(header.isNotNull().cast("int")).over(w))


def section_texts(lines: DataFrame, doc: str, order: list[str], header: Column, text: str = "texto") -> DataFrame:
    """(doc, segmento, seccion, cuerpo): the text below each header, in line order."""
    rows = segments(lines, doc, order, header).withColumn("_h", header)
    ordered = F.array_sort(F.collect_list(F.when(F.col("_h").isNull(), F.struct(*order, F.col(text).alias("_t")))))
    return (
        rows.where("segmento > 0")
        .groupBy(doc, "segmento")
        .agg(F.max("_h").alias("seccion"), ordered.alias("_l"))
        .select(doc, "segmento", "seccion", F.array_join(F.transform("_l", lambda x: x["_t"]), "\n").alias("cuerpo"))
    )


def joined_names(lines: DataFrame, doc: str, order: list[str], text: str = "texto") -> DataFrame:
    """Lines with an unclosed parenthesis take the next line; that line is dropped."""
    w = W.partitionBy(doc).orderBy(*order)
    count = lambda c, ch: F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))
    opened = lambda c: count(c, "(") > count(c, ")")
    following = F.lead(text).over(w)
    # a line that is itself taken cannot take another one: only the first of a chain opens
    rows = lines.withColumn("_abre", opened(F.col(text))).withColumn("_sig", following)
    rows = rows.withColumn("_tomada", F.coalesce(F.lag("_abre").over(w), F.lit(False)))
    merged = F.when(F.col("_abre") & F.col("_sig").isNotNull(), F.concat_ws(" ", F.col(text), F.trim("_sig")))
    return (
        rows.where(~F.col("_tomada") | F.col("_abre"))
        .withColumn(text, F.coalesce(merged, F.col(text)))
        .drop("_abre", "_sig", "_tomada")
    )


def value_near_label(lines: DataFrame, doc: str, order: list[str], label: Column, text: str = "texto") -> DataFrame:
    """Label lines with ``valor``: the first numeric neighbour at -1, +1, -2, +2, -3, +3."""
    w = W.partitionBy(doc).orderBy(*order)
    near = []
    for offset in OFFSETS:
        other = F.trim(F.lag(text, -offset).over(w) if offset < 0 else F.lead(text, offset).over(w))
        near.append(F.when(other.rlike(WINDOW_VALUE), other))
    return lines.withColumn("valor", F.coalesce(*near)).where(label)


def axes_near_label(lines: Column, at: Column) -> Column:
    """Up to three single numbers next to line ``at``: backwards first, else forwards; two needed."""

    def run(part: Column) -> Column:
        fold = F.aggregate(
            part,
            F.struct(F.array().cast("array<string>").alias("v"), F.lit(True).alias("go")),
            lambda acc, x: F.struct(
                F.when(acc["go"] & F.trim(x).rlike(SINGLE_VALUE), F.concat(acc["v"], F.array(F.trim(x)))).otherwise(acc["v"]).alias("v"),
                (acc["go"] & F.trim(x).rlike(SINGLE_VALUE)).alias("go"),
            ),
        )
        return fold["v"]

    back = F.reverse(run(F.reverse(F.slice(lines, F.lit(1), at))))
    ahead = run(F.slice(lines, at + 2, F.size(lines)))
    chosen = F.when(F.size(back) > 0, back).otherwise(ahead)
    return F.when(F.size(chosen) >= 2, F.slice(chosen, 1, 3))


def consistent_header(pages: DataFrame, doc: str, page: str, number: str) -> DataFrame:
    """Per document the number of the first page that has one, and whether pages disagree."""
    return pages.where(F.col(number).isNotNull()).groupBy(doc).agg(
        F.min_by(number, page).alias("numero"),
        (F.min(number) != F.max(number)).alias("inconsistente"),
    )

"""Structural associations, independent inventories and closed domains.

Inventories read the pages on a path of their own: they share no code with the
parsers, otherwise comparing the two would prove nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOW_CONFIDENCE = 0.6
#: Classes of a coverage finding.
FINDING_CLASSES = ["dato", "header", "medida", "coleccion", "seccion"]


def beside_label(lines: Column, label: str, value: Column, reach: int = 3) -> Column:
    """Whether ``value`` stands on a label's line or within ``reach`` lines of one (P10)."""
    clean = F.transform(lines, lambda x: F.trim(x))
    hits = F.filter(F.sequence(F.lit(0), F.greatest(F.size(clean) - 1, F.lit(0))), lambda i: F.get(clean, i.cast("int")).rlike(label))

    def near(i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0)).cast("int")
        window = F.slice(clean, first + 1, (i + reach - first + 1).cast("int"))
        rest = F.trim(F.regexp_extract(F.get(clean, i.cast("int")), label + r"\s*:?\s*(.*)", 1))
        return (rest == value) | F.array_contains(window, value)

    return F.coalesce(F.exists(hits, near), F.lit(False))


def in_one_line(lines: Column, name: Column, value: Column) -> Column:
    """Whether some line holds the measure's name and, behind it, its value."""
    return F.exists(
        lines,
        lambda x: (F.instr(x, name) > 0)
        & F.substring(x, F.instr(x, name) + F.length(name), F.length(x)).contains(value),
    )


def in_order(text: Column, parts: Column) -> Column:
    """Whether all parts occur in the text, each behind the one before."""
    end = F.aggregate(
        parts,
        F.lit(1),
        lambda at, p: F.when(
            (at > 0) & F.substring(text, at, F.length(text)).contains(p),
            at + F.instr(F.substring(text, at, F.length(text)), p) - 1 + F.length(p),
        ).otherwise(F.lit(0)),
    )
    return end > 0


def follows_label(text: Column, label: str, value: Column) -> Column:
    """Whether the first token behind the label is the value."""
    return F.coalesce(F.regexp_extract(text, label + r"\s*(\S+)", 1) == value, F.lit(False))


def laboratory_inventory(docs: DataFrame, key: str, pages: str) -> DataFrame:
    """key, pagina, ordinal of every line that looks like a result below a section."""
    paged = docs.select(key, F.posexplode(pages).alias("pagina", "t"))
    rows = paged.select(key, "pagina", F.posexplode(F.split("t", r"\r?\n")).alias("linea", "x"))
    title = F.upper(F.translate(F.regexp_replace("x", r"^[\s-]+|[\s-]+$", ""), "ÁÉÍÓÚáéíóú", "AEIOUaeiou"))
    is_title = title.rlike(r"^(HEMATOLOGIA|HEMOSTASIA(\s+Y\s+COAGULACION)?|QUIMICA\s+CLINICA|IONOGRAMA(\s+SERICO)?|ORINA(\s+COMPLETA)?)$")
    is_row = (
        F.col("x").rlike(r"^\s*[^|]*\S[^|]*\|")
        | F.col("x").rlike(r"^\s*[^\s:][^:]*?\s{2,}[+-]?\d+([.,]\d+)?(\s{2,}.*|\s*)$")
        | F.col("x").rlike(r"^\s*[^\s:](?:[^:]*?\S)?\s{2,}[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ.+/<>()-]*( [A-ZÁÉÍÓÚÜÑ.+/<>()-]+){0,3}\s*$")
    ) & ~title.rlike("RESULTADO.*(UNIDADES|REFERENCIA)")
    by = W.partitionBy(key).orderBy("pagina", "linea")
    seen = F.max(is_title).over(by.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = rows.withColumn("_v", seen).withColumn("_r", is_row & ~is_title).where("_v AND _r")
    return found.select(key, "pagina", (F.row_number().over(by) - 1).alias("ordinal"))


#: Inventory of the ECG layout: field, class, what announces it. Written apart from the parser's labels.
ECG_MARKS = [
    ("nombre", "header", "~,"), ("id_estudio", "header", r"\bID:"), ("fecha_nac", "header", r"yr\)"),
    ("vent_rate", "medida", r"(?i)\bvent\.? *rate\b"), ("pr_interval", "medida", r"\bPR\b"), ("qrs_duration", "medida", r"\bQRS\b"),
    ("qt_qtc", "medida", "QT/QTc"), ("ejes", "medida", r"\bP-R-T\b"),
]


def ecg_inventory(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, campo, clase, pagina of every announced field, once per announcement."""
    found = F.array(
        *[F.struct(F.lit(n).alias("campo"), F.lit(c).alias("clase"), F.size(F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias("veces")) for n, c, p in ECG_MARKS]
    )
    rows = docs.select(key, F.inline(found)).where("veces > 0")
    return rows.select(key, "campo", "clase", F.lit(0).alias("pagina"), F.explode(F.sequence(F.lit(1), "veces")).alias("vez"))


def echo_inventory(docs: DataFrame, key: str, pages: str) -> DataFrame:
    """key, pagina, ordinal of every line between MEDIDAS and the next title that has a bar."""
    paged = docs.select(key, F.posexplode(pages).alias("pagina", "t"))
    blocks = F.split(F.col("t"), r"(?m)^\s*MEDIDAS\s*$")
    after = F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), lambda b: F.split(F.split(b, r"(?m)^\s*[A-ZÁÉÍÓÚ ]{6,}:?\s*$")[0], r"\r?\n")))
    lines = paged.select(key, "pagina", F.posexplode(F.filter(after, lambda x: x.contains("|"))).alias("linea", "x"))
    by = W.partitionBy(key).orderBy("pagina", "linea")
    return lines.select(key, "pagina", (F.row_number().over(by) - 1).alias("ordinal"))


#: Printed lines that need no reference, in lower case.
PERMITTED = {"ecg": ["pid / name mismatch"], "ecocardiograma": ["diagnostico por imagenes"]}


def permitted_text(line: Column, kind: str) -> Column:
    """Whether a printed line is furniture of its layout and needs no reference."""
    key = F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))
    if kind == "laboratorio":
        return key.contains("resultado") & (key.contains("unidades") | key.contains("referencia"))
    return key.isin(PERMITTED.get(kind, []))


def first_per_field(rows: DataFrame, doc: str, field: str, order: list[str]) -> DataFrame:
    """The first row of every field of a document (W13), with map-side combine."""
    rest = [c for c in rows.columns if c not in (doc, field)]
    first = rows.groupBy(doc, field).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_x"))
    return first.select(doc, field, *[F.col(f"_x.{c}").alias(c) for c in rest])


def outside_domain(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with ``regla``: name of the first one."""
    broken = F.lit(None).cast("string")
    for name, valid in reversed(rules.items()):
        broken = F.when(~F.coalesce(valid, F.lit(False)), F.lit(name)).otherwise(broken)
    return rows.withColumn("regla", broken).where("regla IS NOT NULL")


def low_confidence(score: Column) -> Column:
    """A mark, never a reason to drop."""
    return score < LOW_CONFIDENCE


def classified(patient: list[Column], physician: list[Column], internal: list[Column]) -> Column:
    """Rows (espacio, valor, puntaje) of the identities of a document, for ``inline``."""
    parts = [
        F.struct(F.lit(space).alias("espacio"), c.cast("string").alias("valor"), F.lit(1.0).alias("puntaje"))
        for space, cols in (("paciente", patient), ("medico", physician), ("cuasi_id", internal))
        for c in cols
    ]
    return F.filter(F.array(*parts), lambda p: p["valor"].isNotNull() & (F.trim(p["valor"]) != ""))

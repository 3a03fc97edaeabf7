"""The assembled pipeline over all studies: bridge, date, gate, redaction, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordal.functions import keys, masking
from cordal.plans.linking import _DESTINATIONS, SECRET, gated, studies
from cordal.plans.pipeline import Pipeline
from cordal.plans.registry import Registry
from cordal.plans.texts import _EMAIL, _RED, email_spans
from cordal.session import table

registry = Registry()

_SECTIONS = f"""{_DESTINATIONS},
t1 AS (SELECT DISTINCT id_estudio, id_seccion, texto, {_RED.format(t='texto')} AS x FROM texto_seccion_eco WHERE texto IS NOT NULL),
t2 AS (SELECT id_estudio, id_seccion, {_RED.format(t='substr(x, 2, length(x) - 2)')} AS y FROM t1),
t3 AS (SELECT id_estudio, id_seccion, regexp_replace(substr(y, 2, length(y) - 2), '{_EMAIL}', '[REDACTADO]', 'g') AS t FROM t2),
t AS (SELECT t3.* FROM t3 JOIN d USING (id_estudio) WHERE destino = 'aprobado')"""


def _redacted(text: Column) -> Column:
    """Ids and e-mail addresses; names need a detector, the tables know none of the patients'."""
    none = F.array().cast("array<string>")
    return masking.redact(text, none, email_spans(masking.redact(text, none)))


def with_texts(sections: DataFrame):
    """Stage: the redacted sections of a study, in their order."""
    rows = sections.where("texto IS NOT NULL").select("id_estudio", "id_seccion", "texto").distinct()
    rows = rows.select("id_estudio", F.struct("id_seccion", _redacted(F.col("texto")).alias("texto")).alias("s"))
    texts = rows.groupBy("id_estudio").agg(F.array_sort(F.collect_list("s")).alias("textos"))
    return lambda docs: docs.join(texts, "id_estudio", "left")


def exported(docs: DataFrame) -> DataFrame:
    """Stage: keyed ids in place of the patient's, and only columns that may go out."""
    return docs.select(
        "id_estudio", keys.patient_key(F.col("resuelto"), SECRET).alias("clave_paciente"),
        keys.episode_key(F.col("resuelto"), F.col("ancla"), SECRET).alias("clave_episodio"),
        "tipo_documento", "fecha_estudio", "textos", "codigo", "etapa",
    )


def staged(spark, sf_dir) -> Pipeline:
    sections = table(spark, sf_dir, "texto_seccion_eco")
    return gated(spark, sf_dir).add("redaccion", with_texts(sections)).add("exportacion", exported)


@registry(
    f"""{_SECTIONS} SELECT id_estudio, {keys.hmac16_sql("CASE WHEN ltrim(paciente, '0') = '' THEN '0' ELSE ltrim(paciente, '0') END", SECRET)} AS clave_paciente,
  {keys.hmac16_sql("paciente || '|' || strftime(ancla, '%Y-%m-%d')", SECRET)} AS clave_episodio, tipo_documento, strftime(fecha, '%Y-%m-%d') AS fecha_estudio,
  (SELECT string_agg(id_seccion || ':' || t, chr(10) ORDER BY id_seccion, t) FROM t WHERE t.id_estudio = d.id_estudio) AS textos FROM d WHERE destino = 'aprobado'"""
)
def pipeline_published(spark, sf_dir):
    """The published studies with their redacted sections."""
    out = staged(spark, sf_dir).run(studies(spark, sf_dir))[0]
    lines = F.transform("textos", lambda s: F.concat(s["id_seccion"].cast("string"), F.lit(":"), s["texto"]))
    return out.withColumns({"fecha_estudio": F.date_format("fecha_estudio", "yyyy-MM-dd"), "textos": F.array_join(lines, "\n")})


@registry(
    f"""{_SECTIONS}, suma AS (SELECT (SELECT count(*) FROM d) AS entrada, (SELECT count(*) FROM d WHERE destino = 'aprobado') AS publicados, (SELECT count(*) FROM d WHERE destino <> 'aprobado') AS en_cuarentena)
SELECT *, entrada - publicados - en_cuarentena AS diferencia, (SELECT count(*) FROM t) AS secciones,
  (SELECT CAST(coalesce(sum((length(t) - length(replace(t, '[REDACTADO]', ''))) // 11), 0) AS BIGINT) FROM t) AS redacciones FROM suma"""
)
def pipeline_totals(spark, sf_dir):
    """Studies in, published, in quarantine; sections published and data redacted in them."""
    docs = studies(spark, sf_dir)
    published, quarantined = staged(spark, sf_dir).run(docs)
    mark = masking.REDACTED
    marks = F.aggregate(
        F.coalesce("textos", F.array()), F.lit(0).cast("long"),
        lambda n, s: n + ((F.length(s["texto"]) - F.length(F.replace(s["texto"], F.lit(mark), F.lit("")))) / len(mark)).cast("long"),
    )
    out = published.agg(
        F.count("*").alias("publicados"), F.coalesce(F.sum(F.size(F.coalesce("textos", F.array()))), F.lit(0)).alias("secciones"),
        F.coalesce(F.sum(marks), F.lit(0)).alias("redacciones"),
    )
    total = docs.agg(F.count("*").alias("entrada")).join(quarantined.agg(F.count("*").alias("en_cuarentena"))).join(out)
    return total.select(
        "entrada", "publicados", "en_cuarentena", (F.col("entrada") - F.col("publicados") - F.col("en_cuarentena")).alias("diferencia"),
        "secciones", "redacciones",
    )

"""From text pages to published and quarantined records, end to end.

A document passes: copies out, text layer, layout, header, identity (directly or by
the bridge that the laboratory documents of the same run build), date, episode
gate. What fails anywhere has a code and a stage, so published plus quarantined is
every distinct document. Only narrow rows (ids, keys, dates, codes) go through the
joins; the pages are read again for the published documents alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordal.functions import keys, masking, values
from cordal.operators import classify, identity, parsers
from cordal.plans.linking import _EPISODES, _N, SECRET, studies, with_date, with_gate
from cordal.plans.pipeline import EntityDetector, Pipeline
from cordal.plans.registry import Registry
from cordal.session import bounded, checkpoint
from cordal.sources.files import readable

registry = Registry()
META = ["documento", "tipo_documento", "dni", "nombre", "fecha_nac", "fecha_estudio", "medico", "codigo", "etapa"]


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The first document of every content, in order of ``documento``; pages are not shuffled.

    ``huella``, the hash of the file, tells contents apart; without it the pages do.
    """
    content = F.col("huella") if "huella" in docs.columns else F.sha2(F.array_join("paginas", "\f"), 256)
    content = docs.select("documento", content.alias("h"))
    first = content.groupBy("h").agg(F.min("documento").alias("primero"))
    copies = checkpoint(content.join(first, "h").where("documento <> primero").select("documento"))
    return docs.join(bounded(copies), "documento", "left_anti")


def _failed(df: DataFrame, stage: str) -> DataFrame:
    return df.select(*[c if c in ("documento", "codigo") else (F.lit(stage) if c == "etapa" else F.lit(None)).alias(c) for c in META])


def headers(docs: DataFrame) -> DataFrame:
    """One narrow row per document: type, identity fields and date of its header, or code and stage."""
    text = F.array_join("paginas", "\n")
    typed = classify.with_kind(readable(docs).withColumn("texto", text), "texto")
    unreadable = _failed(typed.where("codigo IS NOT NULL"), "lectura")
    typed = typed.where("codigo IS NULL").drop("codigo")
    unknown = typed.where(F.col("tipo") == classify.UNKNOWN).withColumn("codigo", F.lit("tipo_no_reconocido"))
    parts = [unreadable, _failed(unknown, "deteccion")]

    ecg = parsers.parse_ecg(typed.where("tipo = 'ecg'"), "documento", "texto")
    parts.append(_header(ecg, "ecg", None, F.col("fecha_nac"), F.col("cabecera.medico_derivante")))
    lab = parsers.laboratory_header(typed.where("tipo = 'laboratorio'"), "documento", "paginas_orden")
    parts.append(_header(lab, "laboratorio", F.col("cabecera.dni"), F.col("fecha_nac"), F.col("cabecera.medico_derivante")))

    echo = parsers.headers(typed.where("tipo = 'ecocardiograma'"), "texto", parsers.ECHO_HEADER)
    h = F.col("cabecera")
    day = values.iso_date(h["fecha"])
    detail = F.when(h["nombre"].isNull(), "nombre_ausente").when(h["fecha"].isNull(), "fecha_ausente").when(day.isNull(), "fecha_ilegible")
    echo = echo.withColumn("fecha_estudio", day).withColumn("codigo", F.when(detail.isNotNull(), "parseo_incompleto"))
    parts.append(_header(echo, "ecocardiograma", h["dni"], F.lit(None), h["medico_solicitante"]))
    return reduce(DataFrame.unionByName, parts)


def _header(df: DataFrame, kind: str, dni: Column | None, birth: Column, physician: Column) -> DataFrame:
    return df.select(
        "documento", F.lit(kind).alias("tipo_documento"), (F.lit(None) if dni is None else dni).cast("string").alias("dni"),
        F.col("cabecera.nombre").alias("nombre"), birth.cast("string").alias("fecha_nac"), "fecha_estudio", physician.alias("medico"), "codigo",
        F.when(F.col("codigo").isNotNull(), "parseo").alias("etapa"),
    )


@dataclass
class Processed:
    """What a run leaves: narrow records of both outcomes, and the child rows of the published ones."""

    publicados: DataFrame
    cuarentena: DataFrame
    mediciones_ecg: DataFrame
    resultados: DataFrame
    medidas_eco: DataFrame
    textos_eco: DataFrame


def process(docs: DataFrame, secret: bytes, detector: EntityDetector | None = None) -> Processed:
    """``docs`` (documento, paginas, paginas_orden) through all stages.

    ``detector`` finds further (inicio, fin) spans in the texts of the echo
    sections; without one, ids and the names of the document itself are redacted.
    """
    docs = distinct_documents(docs)
    meta = checkpoint(headers(docs))
    keyed = meta.withColumn("id_paciente", F.when(F.col("dni").isNotNull(), keys.patient_key(F.col("dni"), secret)))
    keyed = keyed.withColumn("id_alt_paciente", keys.alternative_key(F.col("nombre"), F.col("fecha_nac"), secret))
    pairs = keyed.where("codigo IS NULL AND tipo_documento = 'laboratorio'")
    bridge = identity.build_bridge(pairs, "id_alt_paciente", "id_paciente")
    stages = Pipeline().add("identidad", lambda d: identity.resolve(d, bridge, "id_alt_paciente", "id_paciente"))
    published, quarantined = stages.add("fecha", with_date).add("episodio", with_gate).run(keyed)
    episode = keys.episode_key(F.col("resuelto"), F.col("ancla"), secret)
    published = checkpoint(published.withColumn("id_episodio", episode))
    own = docs.join(published.select("documento", "id_episodio", "tipo_documento", "nombre", "medico"), "documento")

    ecg = own.where("tipo_documento = 'ecg'").withColumn("texto", F.array_join("paginas", "\n"))
    measures = parsers.parse_ecg(ecg.withColumn("doc", F.struct("documento", "id_episodio")), "doc", "texto")
    results = parsers.parse_laboratory(own.where("tipo_documento = 'laboratorio'"), "documento", "paginas_orden")
    classed = parsers.echo_lines(own.where("tipo_documento = 'ecocardiograma'"), "documento", "paginas_orden")
    texts = parsers.parse_echo_sections(classed, "documento").join(published.select("documento", "nombre", "medico"), "documento")
    redacted = masking.redact(F.col("texto"), F.array("nombre", "medico"))
    texts = texts.withColumn("texto", redacted)
    if detector is not None:
        texts = detector(texts, "texto").withColumn("texto", masking.redact_spans(F.col("texto"), F.col("spans")))
    safe = lambda df: _with_keys(df, published, secret)
    return Processed(
        publicados=published.select(
            keys.document_key(F.sha2("documento", 256), secret).alias("clave_documento"), "id_episodio", F.col("resuelto").alias("id_paciente"),
            "tipo_documento", "fecha_estudio", keys.physician_key(F.col("medico"), secret).alias("id_medico"),
        ),
        cuarentena=quarantined.select("documento", "tipo_documento", "etapa", "codigo"),
        mediciones_ecg=safe(measures.select("doc.documento", *parsers.ECG_MEASURES)),
        resultados=safe(results.select("documento", "ordinal", "seccion", "prueba", "resultado", "unidades", "valores_referencia")),
        medidas_eco=safe(parsers.parse_echo_measures(classed, "documento").select("documento", "ordinal", "nombre", "valor", "unidad")),
        textos_eco=safe(texts.select("documento", "segmento", "seccion", "texto")),
    )


def _with_keys(df: DataFrame, published: DataFrame, secret: bytes) -> DataFrame:
    """Child rows under the keys of their document and episode instead of its name."""
    key = keys.document_key(F.sha2("documento", 256), secret).alias("clave_documento")
    return df.join(published.select("documento", "id_episodio"), "documento").select(key, "id_episodio", *df.columns[1:])


def study_pages(spark, sf_dir) -> DataFrame:
    """Text pages of every distinct study of ``estudio``, as its layout prints them."""
    rows = studies(spark, sf_dir)
    number = (F.conv(F.substring(F.md5("id_paciente"), 1, 7), 16, 10).cast("long") % 90_000_000 + 10_000_000).cast("string")
    day, line = F.date_format("fecha_estudio", "dd/MM/yyyy"), lambda label, value: F.concat(F.lit(label), value, F.lit("\n"))
    name = F.concat("id_alt_paciente", F.lit(", X"))
    some = lambda c: F.coalesce(c, F.lit(""))
    lab = F.concat(
        some(line("Apellido y Nombre: ", name)), some(line("DNI: ", number)), F.lit("F.Nacimiento: 01/01/1980\n"),
        line("Nº Petición: ", F.col("id_estudio").cast("string")), some(line("Fecha: ", day)), F.lit("HEMATOLOGIA\nGlucosa | 90 | mg/dL | 70 - 110\n"),
    )
    moment = F.concat(F.upper(F.date_format("fecha_estudio", "dd-MMM-yyyy")), F.lit("  03:04:05"))
    ecg = F.concat(
        F.coalesce(F.concat(name, F.lit("~,  ")), F.lit("")), F.lit("ID:"), F.col("id_estudio").cast("string"), F.lit("  "), some(moment), F.lit("   Hospital\n"),
        F.lit("01-JAN-1980 (40 yr) Male\nVent. rate 60\nMORTARA\n"),
    )
    echo = F.concat(
        F.lit("SERVICIO DE ECOCARDIOGRAFIA\n"), line("Paciente: ", F.lit("Paz, Ana")), some(line("Documento: ", number)),
        line("Nº Estudio: ", F.col("id_estudio").cast("string")), some(line("Fecha Estudio: ", day)), F.lit("MEDIDAS\nAO | 30 | mm\nCONCLUSIONES\nPaz, Ana: normal.\n"),
    )
    text = F.when(F.col("tipo_documento") == "laboratorio", lab).when(F.col("tipo_documento") == "ecg", ecg).otherwise(echo)
    page = F.array(text)
    return rows.select(F.col("id_estudio").cast("string").alias("documento"), page.alias("paginas"), page.alias("paginas_orden"))


@registry(
    _EPISODES[: _EPISODES.index("days AS")]
    + f"""h AS (SELECT CAST(id_estudio AS VARCHAR) AS documento, tipo_documento, fecha_estudio, CASE WHEN tipo_documento <> 'ecg' THEN {_N.format(c='id_paciente')} END AS dni,
  CASE WHEN tipo_documento <> 'ecocardiograma' THEN id_alt_paciente END AS alt,
  CASE WHEN fecha_estudio IS NULL OR (id_alt_paciente IS NULL AND tipo_documento <> 'ecocardiograma') THEN 'parseo_incompleto' END AS c FROM studies),
b AS (SELECT alt, min(dni) AS dni, count(DISTINCT dni) AS n FROM h WHERE c IS NULL AND tipo_documento = 'laboratorio' AND dni IS NOT NULL GROUP BY 1),
r AS (SELECT documento, h.tipo_documento, fecha_estudio AS fecha, c, coalesce(h.dni, CASE WHEN n = 1 THEN b.dni END) AS paciente, coalesce(n > 1, false) AS ambiguo FROM h LEFT JOIN b ON h.alt = b.alt),
n AS (SELECT *, row_number() OVER (PARTITION BY paciente ORDER BY fecha) AS k FROM (SELECT DISTINCT paciente, fecha FROM r WHERE c IS NULL AND paciente IS NOT NULL)),
walk AS (SELECT paciente, fecha, k, fecha AS ancla FROM n WHERE k = 1 UNION ALL
  SELECT n.paciente, n.fecha, n.k, CASE WHEN n.fecha - w.ancla <= 7 THEN w.ancla ELSE n.fecha END FROM walk w JOIN n ON n.paciente = w.paciente AND n.k = w.k + 1),
a AS (SELECT r.*, w.ancla FROM r LEFT JOIN walk w ON r.paciente = w.paciente AND r.fecha = w.fecha AND r.c IS NULL),
e AS (SELECT paciente, ancla, count(*) AS docs, count(DISTINCT tipo_documento) AS tipos FROM a WHERE ancla IS NOT NULL GROUP BY ALL)
SELECT documento, a.tipo_documento, CASE WHEN c IS NOT NULL THEN c WHEN a.paciente IS NULL THEN CASE WHEN ambiguo THEN 'clave_pii_ambigua' ELSE 'clave_pii_no_resuelta' END
  WHEN docs > tipos THEN 'episodio_ambiguo' WHEN tipos < 3 THEN 'episodio_incompleto' ELSE 'publicado' END AS destino FROM a LEFT JOIN e ON a.paciente = e.paciente AND a.ancla = e.ancla"""
)
def process_pages(spark, sf_dir):
    """Where every study ends when its printed pages go through the whole run."""
    docs = checkpoint(study_pages(spark, sf_dir))  # pages lie in storage, as a run finds them
    done = process(docs, SECRET)
    key = keys.document_key(F.sha2("documento", 256), SECRET).alias("clave_documento")
    published = done.publicados.join(docs.select("documento", key), "clave_documento")
    return published.select("documento", "tipo_documento", F.lit("publicado").alias("destino")).unionByName(
        done.cuarentena.select("documento", "tipo_documento", F.col("codigo").alias("destino"))
    )

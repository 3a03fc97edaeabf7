"""Queries: headers, sections and signatures of printed pages, made from the tables and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cordal.operators import parsers, reconcile
from cordal.plans.linking import _N
from cordal.plans.registry import Registry
from cordal.session import table

registry = Registry()


@registry(
    f"""WITH s AS (SELECT DISTINCT id_estudio AS id, id_paciente, id_alt_paciente AS alt, CAST(fecha_estudio AS DATE) AS f, hora_estudio AS h0, trim(hora_estudio, ' ') AS h
  FROM estudio WHERE tipo_documento = 'laboratorio'),
t AS (SELECT *, CASE WHEN regexp_matches(h, '^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$') THEN CASE WHEN length(h) = 5 THEN h || ':00' ELSE h END END AS hora FROM s)
SELECT id AS id_estudio, alt || ', X' AS nombre, {_N.format(c='id_paciente')} AS dni, CASE WHEN id % 17 = 0 AND id % 3 = 0 THEN id + 1 ELSE id END::VARCHAR AS peticion,
  strftime(f, '%Y-%m-%d') AS fecha, hora, CASE WHEN coalesce(h, '') = '' THEN 'ausente' WHEN hora IS NULL THEN NULL WHEN length(h) = 5 THEN 'minuto' ELSE 'segundo' END AS precision_hora,
  CASE WHEN id % 5 <> 0 THEN strftime(DATE '1950-01-01' + CAST(id % 20000 AS INTEGER), '%Y-%m-%d') END AS nacido, '40 a' AS edad,
  CASE WHEN id % 17 = 0 AND id % 3 <> 0 THEN 'numero_peticion_inconsistente' WHEN alt IS NULL THEN 'nombre_ausente' WHEN f IS NULL THEN 'fecha_ausente'
    WHEN coalesce(h, '') <> '' AND hora IS NULL THEN 'hora_ilegible' END AS detalle FROM t"""
)
def laboratory_headers(spark, sf_dir):
    """Headers over two pages; the first page with a number counts, two numbers are an error."""
    rows = table(spark, sf_dir, "estudio").where("tipo_documento = 'laboratorio'")
    rows = rows.select("id_estudio", "id_paciente", "id_alt_paciente", "fecha_estudio", "hora_estudio").distinct()
    n = F.col("id_estudio")
    number = (F.conv(F.substring(F.md5("id_paciente"), 1, 7), 16, 10).cast("long") % 90_000_000 + 10_000_000).cast("string")
    born = F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), n % 20_000), "dd/MM/yyyy")
    line = lambda label, value: F.coalesce(F.concat(F.lit(label), value, F.lit("\n")), F.lit(""))

    def page(petition):
        return F.concat(
            line("Apellido y Nombre: ", F.concat("id_alt_paciente", F.lit(", X"))), line("DNI: ", F.concat(number, F.lit("     Sala: 4"))),
            line("F.Nacimiento : ", F.when(n % 5 == 0, "s/d").otherwise(born)), F.lit("Edad: 40 a    Sexo: F\nMédico derivante: Ruiz, Pedro\n"),
            line("N° Peticion: ", petition.cast("string")), line("Fecha: ", F.date_format("fecha_estudio", "dd/MM/yyyy")), line("Hora de Extracción: ", F.nullif(F.trim("hora_estudio"), F.lit(""))),
            F.lit("HEMATOLOGIA\nUrea | 30 | mg/dL"),
        )

    first = F.when(n % 3 == 0, F.lit("LABORATORIO DE ANALISIS CLINICOS\n")).otherwise(page(n))
    docs = rows.select("id_estudio", F.array(first, page(F.when(n % 17 == 0, n + 1).otherwise(n))).alias("paginas"))
    out, h = parsers.laboratory_header(docs, "id_estudio", "paginas"), F.col("cabecera")
    return out.select(
        "id_estudio", h["nombre"].alias("nombre"), h["dni"].alias("dni"), h["numero_peticion"].alias("peticion"), F.date_format("fecha_estudio", "yyyy-MM-dd").alias("fecha"),
        F.col("hora_estudio").alias("hora"), "precision_hora", F.col("fecha_nac").alias("nacido"), F.col("adicionales")["edad"].alias("edad"), "detalle",
    )


#: Titles that the dictated sections are printed under, by turns; the last one is a subsection.
_TITLES = ["MOTILIDAD SEGMENTARIA", "PERICARDIO", "CONCLUSIONES", "VALVULAS CARDIACAS\nMITRAL:"]
_PARSED = [t.replace("\n", " - ").rstrip(":") for t in _TITLES]


@registry(
    f"""WITH s AS (SELECT DISTINCT id_seccion, id_estudio, '* ' || trim(regexp_replace(texto, '[\\s\\x0b]+', ' ', 'g'), ' ') AS t FROM texto_seccion_eco WHERE texto IS NOT NULL)
SELECT id_estudio, CAST(row_number() OVER w AS BIGINT) AS orden, [{', '.join(f"'{t}'" for t in _PARSED)}][id_seccion % 4 + 1] AS seccion, t AS texto FROM s WINDOW w AS (PARTITION BY id_estudio ORDER BY id_seccion, t)"""
)
def echo_sections(spark, sf_dir):
    """All dictated texts printed under section titles and page furniture, parsed back in order."""
    rows = table(spark, sf_dir, "texto_seccion_eco").where("texto IS NOT NULL").select("id_seccion", "id_estudio", "texto").distinct()
    title = F.array(*[F.lit(t) for t in _TITLES])[(F.col("id_seccion") % 4).cast("int")]
    text = F.concat(F.lit("* "), F.trim(F.regexp_replace("texto", r"\s+", " ")))
    body = F.array_sort(F.collect_list(F.struct("id_seccion", text.alias("t"), title.alias("h"))))
    printed = F.transform(body, lambda x: F.concat(x["h"], F.lit("\nPágina 2 de 3\n"), x["t"], F.lit("\nPaciente: Paz, Ana")))
    pages = rows.groupBy("id_estudio").agg(F.array(F.concat(F.lit("SERVICIO DE ECOCARDIOGRAFIA\n"), F.array_join(printed, "\n"))).alias("p"))
    out = parsers.parse_echo_sections(parsers.echo_lines(pages, "id_estudio", "p"), "id_estudio")
    order = F.row_number().over(parsers.W.partitionBy("id_estudio").orderBy("segmento")).cast("long")
    return out.select("id_estudio", order.alias("orden"), "seccion", "texto")


@registry(
    """WITH f AS (SELECT DISTINCT id_medico, md5(id_medico) AS m FROM firma_medico)
SELECT id_medico, CASE WHEN ascii(m) % 3 = 0 THEN 'Ana Paz' WHEN ascii(m) % 3 = 1 THEN 'LUIS PEÑA GIL' END AS nombre,
  CASE WHEN ascii(m) % 3 = 0 THEN substr(m, 1, 5) WHEN ascii(m) % 3 = 1 THEN 'N 27' || ascii(m) END AS matricula FROM f WHERE ascii(m) % 3 < 2"""
)
def echo_signatures(spark, sf_dir):
    """The last signature of a page: a labelled one, or a name line above a licence; a licence alone is none."""
    rows = table(spark, sf_dir, "firma_medico").select("id_medico").distinct().withColumn("m", F.md5("id_medico"))
    kind = F.ascii("m") % 3
    labelled = F.concat(F.lit("Firma: Otro Nombre - MP 1\nFirma: Ana Paz - MP "), F.substring("m", 1, 5))
    stamped = F.concat(F.lit("DIAGNOSTICO POR IMAGENES\nLUIS PEÑA GIL\nMatrícula n 27"), F.ascii("m").cast("string"))
    tail = F.when(kind == 0, labelled).when(kind == 1, stamped).otherwise(F.lit("Matrícula n 99"))
    pages = rows.select("id_medico", F.array(F.concat(F.lit("CONCLUSIONES\nnormal\n"), tail)).alias("p"))
    return parsers.parse_echo_signature(parsers.echo_lines(pages, "id_medico", "p"), "id_medico")


@registry(
    """WITH m AS (SELECT DISTINCT id_medida, trim(nombre, ' ') AS n, trim(valor, ' ') AS v FROM medida_eco  WHERE nombre IS NOT NULL AND valor IS NOT NULL)
SELECT id_medida, true AS en_linea, n <> v AND contains(substr('Otro | ' || n || ' | ' || v, 1), v) AS en_orden, false AS invertido FROM m"""
)
def echo_associations(spark, sf_dir):
    """A measure's value stands behind its name on one line, and never in front of it."""
    rows = table(spark, sf_dir, "medida_eco").select("id_medida", F.trim("nombre").alias("n"), F.trim("valor").alias("v")).distinct()
    rows = rows.where("n IS NOT NULL AND v IS NOT NULL")
    lines = F.array(F.lit("Otro"), F.concat_ws(" | ", F.lit("Otro"), "n", "v"))
    text = F.array_join(lines, "\n")
    return rows.select(
        "id_medida", reconcile.in_one_line(lines, F.col("n"), F.col("v")).alias("en_linea"), reconcile.in_order(text, F.array("n", "v")).alias("en_orden"),
        reconcile.in_order(text, F.array("v", "n")).alias("invertido"),
    )

"""Queries: layout parsers over pages made of the tables, reconciliation, SQL functions, backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from cordal.functions import sql
from cordal.operators import evidence, lines, output, parsers, reconcile
from cordal.plans.linking import SECRET
from cordal.plans.registry import Registry
from cordal.session import table

registry = Registry()

_CELL = "trim(regexp_replace(coalesce({c}, ''), '[\\r\\n\\t|]+', ' ', 'g'), ' ')"
_TITLE = "regexp_replace(upper(trim(trim(trim(translate({c}, 'ÁÉÍÓÚáéíóúÜüÀÈÌÒÙàèìòù', 'AEIOUaeiouUuAEIOUaeiou'), ' '), '-'), ' ')), '\\s+', ' ', 'g')"
_LAB = f"""f AS (SELECT DISTINCT id_fila, id_estudio, {_CELL.format(c='seccion')} AS t, {_CELL.format(c='prueba')} AS prueba, {_CELL.format(c='resultado')} AS resultado,
  {_CELL.format(c='unidades')} AS u, seccion, prueba AS p0, resultado AS r0, unidades AS u0 FROM laboratorio_crudo),
k AS (SELECT *, CASE WHEN {_TITLE.format(c='t')} = 'IONOGRAMA SERICO' THEN 'IONOGRAMA' ELSE {_TITLE.format(c='t')} END AS k FROM f),
o AS (SELECT *, last_value(CASE WHEN k IN ('HEMATOLOGIA', 'HEMOSTASIA', 'QUIMICA CLINICA', 'IONOGRAMA', 'HEMOSTASIA Y COAGULACION', 'ORINA', 'ORINA COMPLETA') THEN k END IGNORE NULLS)
  OVER (PARTITION BY id_estudio ORDER BY id_fila, k, p0, r0, u0 ROWS UNBOUNDED PRECEDING) AS s FROM k),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id_estudio ORDER BY id_fila, k, p0, r0, u0) - 1 AS INTEGER) AS ordinal FROM o WHERE s IS NOT NULL)"""


def _cell(name):
    """A printed cell holds no line break and no bar: they are blanks there."""
    return F.regexp_replace(F.coalesce(name, F.lit("")), r"[\r\n\t|]+", " ")


def _lab_pages(spark, sf_dir):
    """One page per study: a section line and a result line per raw row."""
    rows = table(spark, sf_dir, "laboratorio_crudo").select("id_fila", "id_estudio", "seccion", "prueba", "resultado", "unidades").distinct()
    title = F.coalesce(F.concat(F.when(F.col("seccion").isNotNull(), _cell("seccion")), F.lit("\n")), F.lit(""))
    line = F.concat(title, F.concat_ws(" | ", _cell("prueba"), _cell("resultado"), _cell("unidades")))
    body = F.array_sort(F.collect_list(F.struct("id_fila", line.alias("x"))))
    pages = rows.groupBy("id_estudio").agg(body.alias("b"))
    return pages.select("id_estudio", F.array(F.array_join(F.transform("b", lambda x: x["x"]), "\n")).alias("paginas"))


def _echo_pages(spark, sf_dir):
    """One page per study: its measures between two titles."""
    rows = table(spark, sf_dir, "medida_eco").select("id_medida", "id_estudio", "nombre", "valor", "unidad").distinct()
    line = F.concat_ws(" | ", _cell("nombre"), _cell("valor"), _cell("unidad"))
    pages = rows.groupBy("id_estudio").agg(F.array_sort(F.collect_list(F.struct("id_medida", line.alias("x")))).alias("b"))
    text = F.concat(F.lit("MEDIDAS\n"), F.array_join(F.transform("b", lambda x: x["x"]), "\n"), F.lit("\nCONCLUSIONES\nNormal."))
    return pages.select("id_estudio", F.array(text).alias("p"))


@registry(f"WITH {_LAB} SELECT id_estudio, ordinal, s AS seccion, prueba, resultado, nullif(u, '') AS unidades FROM r")
def parse_laboratory_pages(spark, sf_dir):
    """Pages of all raw laboratory rows parsed back into rows."""
    out = parsers.parse_laboratory(_lab_pages(spark, sf_dir), "id_estudio", "paginas")
    return out.select("id_estudio", "ordinal", "seccion", "prueba", "resultado", "unidades")


@registry(
    f"""WITH {_LAB}, i AS (SELECT id_estudio, ordinal FROM r), m AS (SELECT id_estudio, ordinal, 1 AS x FROM r WHERE ordinal % 7 <> 3)
SELECT id_estudio, ordinal, CAST(1 AS BIGINT) AS n_inv, CAST(x IS NOT NULL AS BIGINT) AS n_ref, 0 AS pagina,
  CASE WHEN x IS NULL THEN 'campo_no_extraido' END AS codigo FROM i LEFT JOIN m USING (id_estudio, ordinal)"""
)
def reconcile_laboratory_pages(spark, sf_dir):
    """An independent inventory of the pages against the parsed rows; every seventh reference is withheld and has to be missed."""
    pages = _lab_pages(spark, sf_dir)
    found = reconcile.laboratory_inventory(pages, "id_estudio", "paginas")
    cited = parsers.parse_laboratory(pages, "id_estudio", "paginas").select("id_estudio", "pagina", "ordinal")
    return evidence.coverage(found, cited.where("ordinal % 7 <> 3"), ["id_estudio", "ordinal"], "pagina")


@registry(
    f"""WITH f AS (SELECT DISTINCT id_medida, id_estudio, nombre AS n0, valor AS v0, unidad AS u0, {_CELL.format(c='nombre')} AS nombre, {_CELL.format(c='valor')} AS valor, {_CELL.format(c='unidad')} AS u FROM medida_eco)
SELECT id_estudio, CAST(row_number() OVER (PARTITION BY id_estudio ORDER BY id_medida, nombre, valor, u) - 1 AS INTEGER) AS ordinal, nombre, valor, nullif(u, '') AS unidad FROM f"""
)
def parse_echo_pages(spark, sf_dir):
    """Pages of all echo measures parsed back into measures."""
    classed = parsers.echo_lines(_echo_pages(spark, sf_dir), "id_estudio", "p")
    return parsers.parse_echo_measures(classed, "id_estudio").select("id_estudio", "ordinal", "nombre", "valor", "unidad")


@registry(
    f"""WITH f AS (SELECT DISTINCT id_medida, id_estudio, nombre AS n0, valor AS v0, unidad AS u0, {_CELL.format(c='nombre')} AS nombre, {_CELL.format(c='valor')} AS valor, {_CELL.format(c='unidad')} AS u FROM medida_eco),
i AS (SELECT id_estudio, CAST(row_number() OVER (PARTITION BY id_estudio ORDER BY id_medida, nombre, valor, u) - 1 AS INTEGER) AS ordinal FROM f)
SELECT id_estudio, ordinal, CAST(1 AS BIGINT) AS n_inv, CAST(ordinal % 5 <> 2 AS BIGINT) AS n_ref, 0 AS pagina, CASE WHEN ordinal % 5 = 2 THEN 'campo_no_extraido' END AS codigo FROM i"""
)
def reconcile_echo_pages(spark, sf_dir):
    """The inventory of echo pages against the parsed measures; every fifth reference is withheld and has to be missed."""
    pages = _echo_pages(spark, sf_dir)
    found = reconcile.echo_inventory(pages, "id_estudio", "p")
    cited = parsers.parse_echo_measures(parsers.echo_lines(pages, "id_estudio", "p"), "id_estudio").select("id_estudio", "pagina", "ordinal")
    return evidence.coverage(found, cited.where("ordinal % 5 <> 2"), ["id_estudio", "ordinal"], "pagina")


#: Printed labels of the five ECG measures.
_ECG_LABELS = {"vent_rate": "Vent. rate", "pr_interval": "PR interval", "qrs_duration": "QRS duration", "qt_qtc": "QT/QTc", "ejes": "P-R-T axes"}
_ECG_CELL = "trim(regexp_replace({c}, '[\\s\\x0b\\x{{85}}\\x{{2028}}\\x{{2029}}]+', ' ', 'g'), ' ')"


def _ecg_pages(rows):
    """A page per row: a bare number stands above its label, anything else behind it.

    Every label is printed, and further from the next block than the parser
    looks, so a missing value stays missing. Cells hold no line break.
    """
    page = [F.lit("PAZ, ANA~,  ID:1  02-JAN-2020  03:04:05   Hospital")]
    for name, label in _ECG_LABELS.items():
        value = F.trim(F.regexp_replace(name, r"[\s\x{85}\x{2028}\x{2029}]+", " "))
        bare = value.rlike(lines.WINDOW_VALUE) & F.lit(name != "ejes")  # one number beside the axes' label is no axis
        behind = F.concat_ws(" ", F.lit(label), value)
        page.append(F.when(bare, F.concat(value, F.lit(f"\n{label}"))).otherwise(behind))
    text = F.concat_ws("\n" * 4, *page).alias("t")
    return rows.select(F.struct("id_estudio", text).alias("doc"), text)


@registry(
    "WITH e AS (SELECT DISTINCT id_estudio, "
    + ", ".join(f"{n} AS {n}_0, CASE WHEN regexp_matches({n}, '[0-9]') THEN {_ECG_CELL.format(c=n)} END AS {n}" for n in _ECG_LABELS)
    + f""" FROM medicion_ecg)
SELECT id_estudio, {', '.join(_ECG_LABELS)}, '2020-01-02' AS fecha, '03:04:05' AS hora_estudio, CAST(NULL AS VARCHAR) AS codigo,
  vent_rate IS NOT NULL AS anclado, coalesce(vent_rate = pr_interval, false) AS cruzado FROM e"""
)
def parse_ecg_pages(spark, sf_dir):
    """Pages of all ECGs parsed back; a value is anchored to its own label, not to another one."""
    rows = table(spark, sf_dir, "medicion_ecg").select("id_estudio", *_ECG_LABELS).distinct()
    out = parsers.parse_ecg(_ecg_pages(rows), "doc", "t")
    page, rate = F.split("doc.t", "\n"), F.col("vent_rate")
    beside = lambda label: F.coalesce(reconcile.beside_label(page, label.replace(".", r"\."), rate), F.lit(False))
    return out.select(
        "doc.id_estudio", *_ECG_LABELS, F.date_format("fecha_estudio", "yyyy-MM-dd").alias("fecha"), "hora_estudio", "codigo",
        beside(_ECG_LABELS["vent_rate"]).alias("anclado"), beside(_ECG_LABELS["pr_interval"]).alias("cruzado"),
    )


_AGAIN = "1 + len(regexp_extract_all(coalesce(ejes, ''), '\\bQRS\\b'))"  # some axes are written with their wave's name
_MEASURED = " UNION ALL ".join(
    f"SELECT id_estudio, '{n}' AS campo, coalesce(regexp_matches({n}, '[0-9]'), false) AS leido, {_AGAIN if n == 'qrs_duration' else 1} AS n_inv FROM e"
    for n in _ECG_LABELS
)


@registry(
    f"""WITH e AS (SELECT id_estudio, {', '.join(f'max({n}) AS {n}' for n in _ECG_LABELS)} FROM medicion_ecg GROUP BY 1), m AS ({_MEASURED})
SELECT id_estudio, campo, CAST(n_inv AS BIGINT) AS n_inv, CAST(leido AS BIGINT) AS n_ref, 0 AS pagina,
  CASE WHEN n_inv > 1 THEN 'cobertura_ambigua' WHEN NOT leido THEN 'campo_no_extraido' END AS codigo FROM m
UNION ALL SELECT id_estudio, c, 1, 1, 0, NULL FROM e, (VALUES ('nombre'), ('id_estudio')) AS h(c)"""
)
def reconcile_ecg_pages(spark, sf_dir):
    """Labels announced on ECG pages against the fields parsed from them; what was not read is missing."""
    rows = table(spark, sf_dir, "medicion_ecg").groupBy("id_estudio").agg(*[F.max(n).alias(n) for n in _ECG_LABELS])
    docs = _ecg_pages(rows)
    found = reconcile.ecg_inventory(docs, "doc", "t")
    parsed = parsers.parse_ecg(docs, "doc", "t")
    fields = {n: F.col(n) for n in _ECG_LABELS} | {n: F.col("cabecera")[n] for n in ("nombre", "id_estudio")}
    cited = F.filter(F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in fields.items()]), lambda x: x.isNotNull())
    read = parsed.select("doc", F.explode(cited).alias("campo"), F.lit(0).alias("pagina"))
    narrow = lambda df: df.select("doc.id_estudio", "campo", "pagina")
    return evidence.coverage(narrow(found), narrow(read), ["id_estudio", "campo"], "pagina")


@registry(
    """WITH d AS (SELECT DISTINCT id_estudio, tipo_documento, precision_hora, hora_estudio, fecha_estudio FROM estudio)
SELECT * FROM (SELECT id_estudio, CASE WHEN NOT coalesce(tipo_documento IN ('ecg', 'laboratorio'), false) THEN 'tipo' WHEN NOT coalesce((precision_hora = 'ausente') = (hora_estudio IS NULL), false) THEN 'hora'
  WHEN NOT coalesce(fecha_estudio >= DATE '2010-01-01', false) THEN 'fecha' END AS regla FROM d) WHERE regla IS NOT NULL"""
)
def domain_violations(spark, sf_dir):
    """Rows outside closed domains, by the first broken rule."""
    rows = table(spark, sf_dir, "estudio").select("id_estudio", "tipo_documento", "precision_hora", "hora_estudio", "fecha_estudio").distinct()
    rules = {
        "tipo": F.col("tipo_documento").isin("ecg", "laboratorio"),
        "hora": (F.col("precision_hora") == "ausente") == F.col("hora_estudio").isNull(),
        "fecha": F.col("fecha_estudio") >= F.lit("2010-01-01").cast("date"),
    }
    return reconcile.outside_domain(rows, rules).select("id_estudio", "regla")


@registry(
    """WITH d AS (SELECT DISTINCT id_medico, nombre, matricula FROM firma_medico)
SELECT id_medico, 'paciente' AS espacio, nombre AS valor, false AS baja FROM d WHERE trim(nombre) <> '' UNION ALL SELECT id_medico, 'medico', matricula, false FROM d WHERE trim(matricula) <> ''
UNION ALL SELECT id_medico, 'cuasi_id', id_medico, false FROM d"""
)
def identity_policy(spark, sf_dir):
    """Identities of a record by namespace, low scores marked."""
    rows = table(spark, sf_dir, "firma_medico").select("id_medico", "nombre", "matricula").distinct()
    parts = reconcile.classified([F.col("nombre")], [F.col("matricula")], [F.col("id_medico")])
    out = rows.select("id_medico", F.inline(parts))
    return out.select("id_medico", "espacio", "valor", reconcile.low_confidence(F.col("puntaje")).alias("baja"))


@registry(
    """WITH p AS (SELECT DISTINCT id_estudio, id_paciente FROM estudio), s AS (SELECT id_estudio, min(id_episodio) AS f FROM medicion_ecg GROUP BY 1)
SELECT id_estudio, coalesce(id_paciente, f) AS id_paciente FROM p LEFT JOIN s USING (id_estudio)"""
)
def backfill_column(spark, sf_dir):
    """Nulls of a column filled from another table."""
    rows = table(spark, sf_dir, "estudio").select("id_estudio", "id_paciente").distinct()
    source = table(spark, sf_dir, "medicion_ecg").select("id_estudio", F.col("id_episodio").alias("id_paciente"))
    return output.backfill(rows, source, "id_estudio", "id_paciente")


@registry(
    "SELECT id_estudio, arg_min(tipo, (fecha, tipo)) AS tipo FROM (SELECT id_estudio, unidad AS tipo, id_medida AS fecha FROM medida_eco WHERE unidad IS NOT NULL) GROUP BY 1"
)
def first_per_field(spark, sf_dir):
    """The first row of a field of a document."""
    rows = table(spark, sf_dir, "medida_eco").where("unidad IS NOT NULL").select(
        "id_estudio", F.lit("unidad").alias("campo"), F.col("unidad").alias("tipo"), F.col("id_medida").alias("fecha")
    )
    return reconcile.first_per_field(rows, "id_estudio", "campo", ["fecha", "tipo"]).select("id_estudio", "tipo")


@registry(
    """SELECT corrida_id, '{"corrida_id":' || coalesce('"' || corrida_id || '"', 'null') || ',"estudios":' || count(DISTINCT id_estudio) || '}' AS carga FROM estudio GROUP BY 1"""
)
def run_payload(spark, sf_dir):
    """A run's read model as a JSON payload."""
    rows = table(spark, sf_dir, "estudio").groupBy("corrida_id").agg(F.count_distinct("id_estudio").alias("estudios"))
    return rows.select("corrida_id", output.payload("carga", F.col("corrida_id"), F.col("estudios")))


@registry(
    """WITH t AS (SELECT doc_id, upper(text) AS u, text FROM documents WHERE text IS NOT NULL)
SELECT doc_id, regexp_replace(regexp_replace(text, '\\pL+', 'X', 'g'), '[0-9]+', '0', 'g') AS forma, coalesce(nullif(ltrim(CAST(doc_id AS VARCHAR), '0'), ''), '0') AS dni FROM t"""
)
def sql_functions(spark, sf_dir):
    """X11: the functions a SQL user calls."""
    sql.register(spark, SECRET)
    table(spark, sf_dir, "documents").createOrReplaceTempView("cordal_documents")
    return spark.sql("SELECT doc_id, shape_mask(text) AS forma, national_id(CAST(doc_id AS STRING)) AS dni FROM cordal_documents WHERE text IS NOT NULL")

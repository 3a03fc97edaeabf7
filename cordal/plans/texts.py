"""Queries: scalar parsers, redaction, masks, line operators, evidence and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from cordal.functions import masking, values
from cordal.operators import evidence, leaks, lines, ordered
from cordal.plans.registry import Registry
from cordal.session import table

registry = Registry()

_NUM = "^[0-9]+([.,][0-9]+)?$"


@registry(
    f"""SELECT DISTINCT id_fila, CASE WHEN regexp_matches(trim(resultado), '{_NUM}') THEN replace(trim(resultado), ',', '.') END AS numero,
  CASE WHEN regexp_matches(trim(resultado), '^[0-9]+([.,][0-9]{{1,2}})?$') THEN replace(trim(resultado), ',', '.') END AS numero_2,
  CASE WHEN regexp_matches(replace(trim(resultado), ',', '.'), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$') THEN TRY_CAST(replace(trim(resultado), ',', '.') AS DOUBLE) END AS flotante
FROM laboratorio_crudo"""
)
def parse_numbers(spark, sf_dir):
    """Numbers with comma or point; words and limits are null."""
    v = F.col("resultado")
    return table(spark, sf_dir, "laboratorio_crudo").select(
        "id_fila",
        values.normal_number(v).alias("numero"),
        values.normal_number(v, 2).alias("numero_2"),
        values.lab_float(v).alias("flotante"),
    ).distinct()


@registry(
    """WITH t AS (SELECT DISTINCT id_estudio, hora_estudio AS h, trim(hora_estudio, ' ') AS v FROM estudio),
i AS (SELECT *, CASE WHEN regexp_matches(v, '^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$') THEN CASE WHEN length(v) = 5 THEN v || ':00' ELSE v END END AS hora FROM t)
SELECT id_estudio, hora, CASE WHEN h IS NULL OR v = '' THEN 'ausente' WHEN hora IS NULL THEN NULL WHEN length(v) = 5 THEN 'minuto' ELSE 'segundo' END AS precision_leida FROM i"""
)
def parse_times(spark, sf_dir):
    """Strict hours; a missing one is 'ausente', an unreadable one null."""
    h = F.col("hora_estudio")
    return table(spark, sf_dir, "estudio").select(
        "id_estudio", values.iso_time(h).alias("hora"), values.time_precision(h).alias("precision_leida")
    ).distinct()


@registry(
    """WITH t AS (SELECT DISTINCT id_estudio, fecha_estudio AS f, CASE id_estudio % 4 WHEN 0 THEN strftime(fecha_estudio, '%Y-%m-%d') WHEN 1 THEN strftime(fecha_estudio, '%d/%m/%Y')
  WHEN 2 THEN strftime(fecha_estudio, '%-d/%-m/%Y') ELSE strftime(fecha_estudio, '%d.%m.%Y') END AS s FROM estudio)
SELECT id_estudio, s AS escrita, CASE WHEN id_estudio % 4 < 3 THEN strftime(f, '%Y-%m-%d') END AS fecha,
  CAST(date_diff('day', DATE '2000-01-01', f) AS INTEGER) AS dias FROM t"""
)
def parse_dates(spark, sf_dir):
    """ISO and slashed dates; other forms are null."""
    k = F.col("id_estudio") % 4
    day = F.col("fecha_estudio")
    written = (
        F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(k == 2, F.date_format(day, "d/M/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy"))
    )
    rows = table(spark, sf_dir, "estudio").select("id_estudio", "fecha_estudio").distinct()
    return rows.select(
        "id_estudio",
        written.alias("escrita"),
        F.date_format(values.iso_date(written), "yyyy-MM-dd").alias("fecha"),
        F.datediff(day, F.lit("2000-01-01").cast("date")).alias("dias"),
    )


@registry(
    """WITH t AS (SELECT DISTINCT id_fila, valores_referencia, string_split(valores_referencia, '-') AS p FROM laboratorio_crudo),
n AS (SELECT *, CASE WHEN len(p) = 2 AND regexp_matches(replace(trim(p[1], ' '), ',', '.'), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$') THEN TRY_CAST(replace(trim(p[1], ' '), ',', '.') AS DOUBLE) END AS a,
  CASE WHEN len(p) = 2 AND regexp_matches(replace(trim(p[2], ' '), ',', '.'), '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$') THEN TRY_CAST(replace(trim(p[2], ' '), ',', '.') AS DOUBLE) END AS b FROM t)
SELECT id_fila, CASE WHEN b IS NOT NULL THEN a END AS ref_min, CASE WHEN a IS NOT NULL THEN b END AS ref_max FROM n"""
)
def reference_range(spark, sf_dir):
    """Bounds of 'min - max'; anything else has none."""
    rows = table(spark, sf_dir, "laboratorio_crudo").select("id_fila", "valores_referencia").distinct()
    return rows.select("id_fila", values.reference_range(F.col("valores_referencia")).alias("r")).select("id_fila", "r.*")


_ACC = "translate(seccion, 'ÁÉÍÓÚáéíóúÜüÀÈÌÒÙàèìòù', 'AEIOUaeiouUuAEIOUaeiou')"


@registry(
    f"""WITH s AS (SELECT DISTINCT seccion, upper(trim(trim(trim({_ACC}), '-'))) AS k FROM laboratorio_crudo)
SELECT seccion, CASE WHEN k = 'IONOGRAMA SERICO' THEN 'IONOGRAMA' ELSE k END AS canonica FROM s"""
)
def canonical_sections(spark, sf_dir):
    """section titles without accents and dashes, aliases resolved."""
    rows = table(spark, sf_dir, "laboratorio_crudo").select("seccion").distinct()
    return rows.select("seccion", values.lab_section(F.col("seccion")).alias("canonica"))


@registry(
    """WITH t AS (SELECT DISTINCT id_medida, valor, regexp_extract(valor, '^\\s*([+-]?[0-9]+(?:[.,][0-9]+)?)\\s*(\\S.*)?$', ['v', 'u']) AS g FROM medida_eco)
SELECT id_medida, CASE WHEN g.v <> '' THEN g.v ELSE trim(valor) END AS valor_solo, nullif(trim(g.u), '') AS unidad_pegada FROM t"""
)
def value_and_unit(spark, sf_dir):
    """number and trailing unit of an echo value."""
    rows = table(spark, sf_dir, "medida_eco").select("id_medida", "valor").distinct()
    parts = rows.select("id_medida", values.value_and_unit(F.col("valor")).alias("p"))
    return parts.select("id_medida", F.col("p.valor").alias("valor_solo"), F.col("p.unidad").alias("unidad_pegada"))


_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@registry(
    f"""SELECT doc_id, trim(regexp_replace(replace(lower(replace(text, '|', ' ')), 'ß', 'ss'), '{_BLANK}+', ' ', 'g'), ' ') AS normal,
  trim(regexp_split_to_array(trim(text, ' '), '{_BLANK}{{2,}}')[1], ' ') AS primer_segmento FROM documents WHERE text IS NOT NULL"""
)
def normal_text(spark, sf_dir):
    """normalised text and first segment of all documents."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select(
        "doc_id", values.normal_text(F.col("text")).alias("normal"), values.first_segment(F.col("text")).alias("primer_segmento")
    )


@registry(
    """SELECT DISTINCT id_estudio, CASE WHEN len(m) > 0 THEN '{' || array_to_string(list_transform(list_sort(m), lambda e: '"' || e.key || '":"' || replace(e.value, '"', '\\"') || '"'), ',') || '}' END AS adicionales_json
FROM (SELECT id_estudio, list_filter(map_entries(adicionales), lambda e: e.key NOT IN ('medico_derivante', 'medico_solicitante', 'tecnico')) AS m FROM estudio)"""
)
def json_sorted_extras(spark, sf_dir):
    """Extras as JSON with sorted keys and without personal ones."""
    from cordal.operators.output import PERSONAL_KEYS

    rows = table(spark, sf_dir, "estudio")
    return rows.select("id_estudio", values.sorted_json(F.col("adicionales"), PERSONAL_KEYS).alias("adicionales_json")).distinct()


@registry(
    """SELECT DISTINCT id_fila, length(trim(resultado)) <= 40 AND len(regexp_split_to_array(trim(resultado), '\\s+')) <= 4
  AND regexp_matches(trim(resultado), '^[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ .+/<>()-]{0,39}$') AS cualitativo,
  regexp_matches(replace(trim(resultado), '.', ''), '^[0-9]{6,8}$') AND coalesce(TRY_CAST(replace(trim(resultado), '.', '') AS BIGINT) BETWEEN 100000 AND 99999999, false) AS id_valido
FROM (SELECT id_fila, upper(resultado) AS resultado FROM laboratorio_crudo WHERE resultado IS NOT NULL)"""
)
def row_predicates(spark, sf_dir):
    """Structured qualitative results and valid national ids."""
    v = F.upper("resultado")
    rows = table(spark, sf_dir, "laboratorio_crudo").where("resultado IS NOT NULL")
    return rows.select(
        "id_fila",
        values.qualitative_result(v).alias("cualitativo"),
        F.coalesce(values.national_id_valid(F.trim(v)), F.lit(False)).alias("id_valido"),
    ).distinct()


@registry(
    """SELECT DISTINCT id_seccion, regexp_replace(regexp_replace(texto, '\\pL+', 'X', 'g'), '[0-9]+', '0', 'g') AS forma
FROM texto_seccion_eco WHERE texto IS NOT NULL"""
)
def shape_mask(spark, sf_dir):
    """Letters and digits of dictated sections as shapes."""
    rows = table(spark, sf_dir, "texto_seccion_eco").where("texto IS NOT NULL")
    return rows.select("id_seccion", masking.shape_mask(F.col("texto")).alias("forma")).distinct()


_RED = (
    "regexp_replace(regexp_replace(' ' || {t} || ' ', '([^0-9.])([0-9]{{1,2}}[.][0-9]{{3}}[.][0-9]{{3}}|[0-9]{{3}}[.][0-9]{{3}})([^0-9])', '\\1[REDACTADO]\\3', 'g'),"
    " '([^0-9])([0-9]{{6,8}})([^0-9])', '\\1[REDACTADO]\\3', 'g')"
)
_TWICE = _RED.format(t="substr({u}, 2, length({u}) - 2)").replace("{u}", "({x})")


@registry(
    f"""WITH a AS (SELECT DISTINCT id_seccion, texto, {_RED.format(t='texto')} AS x FROM texto_seccion_eco WHERE texto IS NOT NULL),
b AS (SELECT id_seccion, {_RED.format(t='substr(x, 2, length(x) - 2)')} AS y FROM a)
SELECT DISTINCT id_seccion, substr(y, 2, length(y) - 2) AS texto_redactado FROM b"""
)
def redact_ids(spark, sf_dir):
    """National ids by shape in dictated sections."""
    rows = table(spark, sf_dir, "texto_seccion_eco").where("texto IS NOT NULL")
    return rows.select("id_seccion", masking.redact_ids(F.col("texto")).alias("texto_redactado")).distinct()


_CHAR = "CASE " + " ".join(
    f"WHEN c IN ('{plain}', '{marked}') THEN '{group}'"
    for plain, marked, group in [("a", "á", "[aáàäâ]"), ("e", "é", "[eéèëê]"), ("i", "í", "[iíìïî]"), ("o", "ó", "[oóòöô]"), ("u", "ú", "[uúùüû]"), ("ü", "ü", "[uúùüû]"), ("n", "ñ", "[nñ]")]
) + " WHEN c = ' ' THEN '(?:\\x01\\s\\x01)+' WHEN regexp_matches(c, '[\\pL\\pN]') THEN c ELSE '\\x01\\' || c || '\\x01' END"
#: RE2 looks neither behind nor ahead: every character that is no letter or digit stands between two marks, so neighbours share none.
_NAMED = f"""m AS (SELECT (ascii(id_medico) * 7 + length(nombre)) % 64 AS k, min(nombre) AS nombre FROM firma_medico WHERE nombre IS NOT NULL GROUP BY 1),
a AS (SELECT DISTINCT id_seccion, texto || coalesce(' Informado por ' || nombre || '.', '') AS texto, trim(regexp_replace(nombre, '[\\s,]+', ' ', 'g'), ' ') AS n
  FROM texto_seccion_eco LEFT JOIN m ON id_seccion % 64 = k WHERE texto IS NOT NULL),
q AS (SELECT *, list_reverse_sort(list_transform(list_distinct(list_filter(list_prepend(n, string_split(n, ' ')), lambda x: length(x) >= 3)), lambda x: {{'l': length(x), 'p': lower(x)}})) AS ps FROM a),
e AS (SELECT *, '(?i)(^|\\x01)(?:' || array_to_string(list_transform(ps, lambda s: array_to_string(list_transform(string_split(s.p, ''), lambda c: {_CHAR}), '')), '|') || ')($|\\x01)' AS pat FROM q),
b AS (SELECT *, {_RED.format(t='texto')} AS x FROM e),
c AS (SELECT *, {_RED.format(t='substr(x, 2, length(x) - 2)')} AS y FROM b),
d AS (SELECT *, substr(y, 2, length(y) - 2) AS ids FROM c),
z AS (SELECT id_seccion, CASE WHEN len(ps) > 0 THEN replace(regexp_replace(regexp_replace(ids, '([^\\pL\\pN])', chr(1) || '\\1' || chr(1), 'g'), pat, '\\1[REDACTADO]\\2', 'g'), chr(1), '') ELSE ids END AS t FROM d)"""


def _signed_sections(spark, sf_dir):
    """Sections with the physician they are signed by: ``texto`` names them, ``nombres`` holds the known names."""
    sections = table(spark, sf_dir, "texto_seccion_eco").where("texto IS NOT NULL").select("id_seccion", "texto").distinct()
    slot = ((F.ascii("id_medico") * 7 + F.length("nombre")) % 64).alias("k")
    physicians = table(spark, sf_dir, "firma_medico").where("nombre IS NOT NULL").groupBy(slot).agg(F.min("nombre").alias("nombre"))
    both = sections.join(F.broadcast(physicians), F.col("id_seccion") % 64 == F.col("k"), "left")  # 64 rows at most
    text = F.concat("texto", F.coalesce(F.concat(F.lit(" Informado por "), "nombre", F.lit(".")), F.lit("")))
    return both.select("id_seccion", text.alias("texto"), F.array("nombre").alias("nombres"))


@registry(f"WITH {_NAMED} SELECT DISTINCT id_seccion, t AS texto_redactado FROM z")
def redact_known_names(spark, sf_dir):
    """The first two layers with the known names of each row."""
    rows = _signed_sections(spark, sf_dir)
    return rows.select("id_seccion", masking.redact(F.col("texto"), F.col("nombres")).alias("texto_redactado")).distinct()


#: Fixed value: an e-mail address, parts of which the layers before may have redacted.
_EMAIL = r"(?:[A-Za-z0-9._+-]|\[REDACTADO\])+@(?:[A-Za-z0-9.-]|\[REDACTADO\])+"


def email_spans(text):
    """(inicio, fin) of every e-mail address, each looked for behind the one before."""
    empty = F.array().cast("array<struct<inicio:int,fin:int>>")

    def step(acc, found):
        start = F.call_function("locate", found, text, F.coalesce(F.try_element_at(acc, F.lit(-1))["fin"], F.lit(0)) + 1) - 1
        return F.concat(acc, F.array(F.struct(start.alias("inicio"), (start + F.length(found)).alias("fin"))))

    return F.aggregate(F.regexp_extract_all(text, F.lit(_EMAIL), F.lit(0)), empty, step)


@registry(f"WITH {_NAMED} SELECT DISTINCT id_seccion, regexp_replace(t, '{_EMAIL}', '[REDACTADO]', 'g') AS texto_redactado FROM z")
def redact_layers(spark, sf_dir):
    """Ids, known names, then spans of a regex detector on what they leave."""
    rows = _signed_sections(spark, sf_dir)
    spans = email_spans(masking.redact(F.col("texto"), F.col("nombres")))
    return rows.select("id_seccion", masking.redact(F.col("texto"), F.col("nombres"), spans).alias("texto_redactado")).distinct()


@registry(
    """WITH r AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 60 AS a, CAST(floor(epoch(ts)) AS BIGINT) // 60 + 30 AS b FROM events),
o AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM r),
i AS (SELECT *, sum(CASE WHEN m IS NULL OR m < a THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM o)
SELECT user_id, min(a) AS inicio, max(b) AS fin FROM i GROUP BY user_id, k"""
)
def span_fusion(spark, sf_dir):
    """Overlapping or touching intervals of a user as islands."""
    a = F.floor(F.unix_timestamp("ts") / 60)
    rows = table(spark, sf_dir, "events").select("user_id", a.alias("a"), (a + 30).alias("b"))
    rows = ordered.maximum_before(rows, "user_id", ["a", "b"], "b", F.floor(F.col("a") / 1440), "m")
    rows = rows.withColumn("n", F.when(F.col("m").isNull() | (F.col("m") < F.col("a")), 1).otherwise(0))
    rows = ordered.running_sum(rows, "user_id", ["a", "b"], "n", "k")
    return rows.groupBy("user_id", "k").agg(F.min("a").alias("inicio"), F.max("b").alias("fin")).drop("k")


_LINES = """l AS (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS texto, generate_subscripts(string_split_regex(text, '\\r\\n|\\r|\\n'), 1) - 1 AS linea
  FROM documents WHERE text IS NOT NULL)"""
_IS_HEADER = r"^[A-ZÁÉÍÓÚÑ][A-ZÁÉÍÓÚÑ ]{3,}$"


def _doc_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return lines.numbered_lines(docs, "doc_id", "text").withColumn("linea", F.col("linea").cast("long"))


def _header():
    return F.when(F.trim("texto").rlike(_IS_HEADER), F.trim("texto"))


@registry(
    f"""WITH {_LINES}, h AS (SELECT *, CASE WHEN regexp_matches(trim(texto), '{_IS_HEADER}') THEN trim(texto) END AS t FROM l)
SELECT doc_id, linea, last_value(t IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY linea ROWS UNBOUNDED PRECEDING) AS seccion,
  CAST(count(t) OVER (PARTITION BY doc_id ORDER BY linea ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segmento FROM h"""
)
def carry_forward_section(spark, sf_dir):
    """The section every line belongs to."""
    rows = lines.carry_forward(_doc_lines(spark, sf_dir), "doc_id", ["linea"], _header())
    return lines.segments(rows, "doc_id", ["linea"], _header()).select("doc_id", "linea", "seccion", "segmento")


@registry(
    f"""WITH {_LINES}, h AS (SELECT *, CASE WHEN regexp_matches(trim(texto), '{_IS_HEADER}') THEN trim(texto) END AS t FROM l),
s AS (SELECT *, count(t) OVER (PARTITION BY doc_id ORDER BY linea ROWS UNBOUNDED PRECEDING) AS segmento FROM h)
SELECT doc_id, CAST(segmento AS BIGINT) AS segmento, max(t) AS seccion, coalesce(string_agg(CASE WHEN t IS NULL THEN texto END, chr(10) ORDER BY linea), '') AS cuerpo
FROM s WHERE segmento > 0 GROUP BY doc_id, segmento"""
)
def section_texts(spark, sf_dir):
    """The text below each section title."""
    return lines.section_texts(_doc_lines(spark, sf_dir), "doc_id", ["linea"], _header())


_CLOSE = "length({c}) - length(replace({c}, '(', '')) > length({c}) - length(replace({c}, ')', ''))"


@registry(
    f"""WITH {_LINES}, w AS (SELECT *, {_CLOSE.format(c='texto')} AS abre, lead(texto) OVER x AS sig, coalesce(lag({_CLOSE.format(c='texto')}) OVER x, false) AS tomada
  FROM l WINDOW x AS (PARTITION BY doc_id ORDER BY linea))
SELECT doc_id, linea, CASE WHEN abre AND sig IS NOT NULL THEN texto || ' ' || trim(sig, ' ') ELSE texto END AS texto FROM w WHERE NOT tomada OR abre"""
)
def joined_names(spark, sf_dir):
    """A line with an unclosed parenthesis takes the next one."""
    return lines.joined_names(_doc_lines(spark, sf_dir), "doc_id", ["linea"]).select("doc_id", "linea", "texto")


_OFF = ", ".join(
    f"CASE WHEN regexp_matches(trim({'lag' if o < 0 else 'lead'}(texto, {abs(o)}) OVER x, ' '), '{lines.WINDOW_VALUE}') THEN trim({'lag' if o < 0 else 'lead'}(texto, {abs(o)}) OVER x, ' ') END"
    for o in lines.OFFSETS
)
_PIECES = "p AS (SELECT id_estudio, unnest(string_split_regex(t, ' ')) AS texto, generate_subscripts(string_split_regex(t, ' '), 1) - 1 AS linea FROM (SELECT DISTINCT id_estudio, coalesce(qt_qtc, '') || ' QT/QTc ' || coalesce(vent_rate, '') || ' Vent ' || coalesce(pr_interval, '') AS t FROM medicion_ecg))"


@registry(
    f"""WITH {_PIECES}, n AS (SELECT *, coalesce({_OFF}) AS valor FROM p WINDOW x AS (PARTITION BY id_estudio ORDER BY linea))
SELECT id_estudio, linea, texto, valor FROM n WHERE texto IN ('QT/QTc', 'Vent')"""
)
def nearest_line_value(spark, sf_dir):
    """The number nearest to a label, earlier neighbours first."""
    part = lambda c: F.coalesce(c, F.lit(""))
    text = F.concat(part("qt_qtc"), F.lit(" QT/QTc "), part("vent_rate"), F.lit(" Vent "), part("pr_interval"))
    rows = table(spark, sf_dir, "medicion_ecg").select("id_estudio", text.alias("t")).distinct()
    pieces = rows.select("id_estudio", F.posexplode(F.split("t", " ")).alias("linea", "texto"))
    out = lines.value_near_label(pieces, "id_estudio", ["linea"], F.col("texto").isin("QT/QTc", "Vent"))
    return out.select("id_estudio", F.col("linea").cast("long").alias("linea"), "texto", "valor")


@registry(
    r"""SELECT doc_id, nullif(trim(string_split_regex(trim(regexp_extract(text, 'Petici[oó]n:?\s*N[ºo°]?\s*(.+)', 1)), '\s{2,}')[1]), '') AS peticion,
  nullif(trim(string_split_regex(trim(regexp_extract(text, 'Edad:\s*(.+)', 1)), '\s{2,}')[1]), '') AS edad FROM documents WHERE text IS NOT NULL"""
)
def header_fields(spark, sf_dir):
    """First match of header fields."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select(
        "doc_id",
        values.header_field(F.col("text"), r"Petici[oó]n:?\s*N[ºo°]?\s*(.+)").alias("peticion"),
        values.header_field(F.col("text"), r"Edad:\s*(.+)").alias("edad"),
    )


@registry(
    """WITH p AS (SELECT doc_id, doc_id // 3 AS doc, doc_id % 3 AS pagina, CASE WHEN doc_id % 7 <> 0 THEN lang END AS numero FROM documents)
SELECT doc, arg_min(numero, pagina) AS numero, min(numero) <> max(numero) AS inconsistente FROM p WHERE numero IS NOT NULL GROUP BY doc"""
)
def consistent_header(spark, sf_dir):
    """The first page that has a number wins; other numbers are inconsistent."""
    doc = F.floor(F.col("doc_id") / 3)
    pages = table(spark, sf_dir, "documents").select(
        doc.alias("doc"), (F.col("doc_id") % 3).alias("pagina"), F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("numero")
    )
    return lines.consistent_header(pages, "doc", "pagina", "numero")


@registry(
    """WITH t AS (SELECT id_estudio, string_agg(texto, chr(10) ORDER BY id_seccion, texto) AS p FROM (SELECT DISTINCT id_estudio, id_seccion, texto FROM texto_seccion_eco WHERE texto IS NOT NULL) GROUP BY 1),
v AS (SELECT DISTINCT m.id_medida, m.valor AS v, t.p FROM medida_eco m LEFT JOIN t USING (id_estudio) WHERE m.valor IS NOT NULL AND m.valor <> ''),
n AS (SELECT *, CAST((length(p) - length(replace(p, v, ''))) / length(v) AS INTEGER) AS n FROM v)
SELECT id_medida, v AS valor, n AS veces, CASE WHEN p IS NULL OR NOT regexp_matches(p, '[0-9]') THEN 'evidencia_ausente' WHEN n = 0 THEN 'valor_discrepante' WHEN n > 1 THEN 'evidencia_ambigua' END AS codigo FROM n"""
)
def evidence_once(spark, sf_dir):
    """A value must occur exactly once in the texts of its study, all sections together."""
    sections = table(spark, sf_dir, "texto_seccion_eco").where("texto IS NOT NULL").select("id_estudio", "id_seccion", "texto").distinct()
    ordered = F.array_sort(F.collect_list(F.struct("id_seccion", "texto")))
    pages = sections.groupBy("id_estudio").agg(F.array_join(F.transform(ordered, lambda x: x["texto"]), "\n").alias("p"))
    rows = table(spark, sf_dir, "medida_eco").where("valor IS NOT NULL AND valor <> ''").select("id_estudio", "id_medida", "valor").distinct()
    return rows.join(pages, "id_estudio", "left").select(
        "id_medida",
        "valor",
        evidence.occurrences(F.col("p"), F.col("valor")).alias("veces"),
        evidence.evidence_code(F.col("p"), F.col("valor")).alias("codigo"),
    ).distinct()


@registry(
    """WITH i AS (SELECT l_orderkey, l_linenumber, count(*) AS n_inv, min(CAST(l_partkey % 9 AS INTEGER)) AS pi FROM lineitem WHERE l_quantity < 45 GROUP BY 1, 2),
r AS (SELECT l_orderkey, l_linenumber, count(*) AS n_ref, min(CAST(CASE WHEN l_suppkey % 17 = 0 THEN 10 ELSE l_partkey % 9 END AS INTEGER)) AS pr FROM lineitem WHERE l_quantity > 5 GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, coalesce(n_inv, 0) AS n_inv, coalesce(n_ref, 0) AS n_ref, coalesce(pi, pr) AS pagina,
  CASE WHEN n_inv > 1 OR n_ref > 1 THEN 'cobertura_ambigua' WHEN n_inv IS NULL OR pi <> pr THEN 'cobertura_incompleta' WHEN n_ref IS NULL THEN 'campo_no_extraido' END AS codigo
FROM i FULL OUTER JOIN r USING (l_orderkey, l_linenumber)"""
)
def coverage_full_outer(spark, sf_dir):
    """Findings against references on (document, ordinal)."""
    page = (F.col("l_partkey") % 9).cast("int")
    rows = table(spark, sf_dir, "lineitem")
    found = rows.where("l_quantity < 45").select("l_orderkey", "l_linenumber", page.alias("pagina"))
    cited = rows.where("l_quantity > 5").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_suppkey") % 17 == 0, F.lit(10)).otherwise(page).alias("pagina")
    )
    return evidence.coverage(found, cited, ["l_orderkey", "l_linenumber"], "pagina")


@registry(
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_linenumber < 6),
b AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 13 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lineitem WHERE l_suppkey % 11 <> 0),
j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, a.l_orderkey IS NOT NULL AS x, b.l_orderkey IS NOT NULL AS y,
  CAST(a.l_partkey IS DISTINCT FROM b.l_partkey AS INTEGER) + CAST(a.l_quantity IS DISTINCT FROM b.l_quantity AS INTEGER) AS d
  FROM a FULL OUTER JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber),
g AS (SELECT l_orderkey, count(*) FILTER (WHERE x AND y) AS pareadas, count(*) FILTER (WHERE x AND NOT y) AS solo_fuente,
  count(*) FILTER (WHERE NOT x AND y) AS solo_modelo, CAST(sum(CASE WHEN x AND y THEN d ELSE 0 END) AS BIGINT) AS celdas_distintas FROM j GROUP BY 1)
SELECT *, CASE WHEN solo_modelo > 0 THEN 'cobertura_incompleta' WHEN celdas_distintas > 0 THEN 'valor_discrepante' END AS codigo FROM g"""
)
def row_alignment(spark, sf_dir):
    """Positional comparison of rows of a document."""
    rows = table(spark, sf_dir, "lineitem")
    left = rows.where("l_linenumber < 6")
    right = rows.where("l_suppkey % 11 <> 0").withColumn(
        "l_quantity", F.when(F.col("l_suppkey") % 13 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    return evidence.align_rows(left, right, "l_orderkey", "l_linenumber", ["l_partkey", "l_quantity"])


@registry(
    """WITH l AS (SELECT lower(nombre) AS w, count(*) AS n FROM analito_ref GROUP BY 1)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS coincidencias FROM documents d JOIN l ON contains(lower(d.text), l.w) GROUP BY 1"""
)
def leak_count(spark, sf_dir):
    """Known literals per record, case folded, by one automaton."""
    return leaks.count_leaks(
        table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "analito_ref"), "nombre"
    )


@registry(
    """WITH t AS (SELECT DISTINCT id_fila, list_filter([unidades, valores_referencia, seccion], lambda x: x IS NOT NULL) AS k FROM laboratorio_crudo)
SELECT id_fila, list_filter(k, lambda x: regexp_matches(x, '^[+-]?[0-9]+(?:[.,][0-9]+)?\\s*-\\s*[+-]?[0-9]+(?:[.,][0-9]+)?$'))[1] AS referencia,
  list_filter(k, lambda x: NOT regexp_matches(x, '^[+-]?[0-9]+(?:[.,][0-9]+)?\\s*-\\s*[+-]?[0-9]+(?:[.,][0-9]+)?$'))[1] AS unidad FROM t"""
)
def extra_columns(spark, sf_dir):
    """which of the loose cells of a row is a range and which a unit."""
    cells = F.array_compact(F.array("unidades", "valores_referencia", "seccion"))
    rows = table(spark, sf_dir, "laboratorio_crudo").select("id_fila", cells.alias("k")).distinct()
    return rows.select("id_fila", values.extra_columns(F.col("k")).alias("p")).select("id_fila", "p.*")

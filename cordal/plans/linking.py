"""Queries: keys, identity bridge, episodes, gate, classification, dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordal.functions import keys
from cordal.operators import classify, dedup, episodes, identity
from cordal.plans.pipeline import Pipeline
from cordal.plans.registry import Registry
from cordal.session import table

registry = Registry()
#: Test secret only; production secrets come from the caller.
SECRET = b"pimienta de prueba"
KINDS = ["ecg", "laboratorio", "ecocardiograma"]

_STUDIES = """studies AS (
  SELECT DISTINCT id_estudio, id_paciente, id_alt_paciente, tipo_documento, CAST(fecha_estudio AS DATE) AS fecha_estudio
  FROM estudio)"""
_EPISODES = f"""WITH RECURSIVE {_STUDIES},
days AS (SELECT DISTINCT id_paciente, fecha_estudio AS fecha FROM studies WHERE id_paciente IS NOT NULL AND fecha_estudio IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY id_paciente ORDER BY fecha) AS k FROM days),
walk AS (
  SELECT id_paciente, fecha, k, fecha AS ancla FROM n WHERE k = 1
  UNION ALL
  SELECT n.id_paciente, n.fecha, n.k, CASE WHEN n.fecha - w.ancla <= 7 THEN w.ancla ELSE n.fecha END
  FROM walk w JOIN n ON n.id_paciente = w.id_paciente AND n.k = w.k + 1),
linked AS (SELECT s.*, w.ancla FROM studies s JOIN walk w ON s.id_paciente = w.id_paciente AND s.fecha_estudio = w.fecha),
ep AS (
  SELECT id_paciente, ancla, count(*) AS documentos, count(DISTINCT tipo_documento) AS tipos,
    bool_or(tipo_documento = 'ecg') AS e, bool_or(tipo_documento = 'laboratorio') AS l, bool_or(tipo_documento = 'ecocardiograma') AS c
  FROM linked GROUP BY ALL)"""
_FALTAN = "concat_ws(',', CASE WHEN NOT e THEN 'ecg' END, CASE WHEN NOT c THEN 'ecocardiograma' END, CASE WHEN NOT l THEN 'laboratorio' END)"
_DATE = "yyyy-MM-dd"
#: A national id made of a key, the same in both engines.
_N = "CAST((('0x' || substr(md5({c}), 1, 7))::BIGINT % 90000000) + 10000000 AS VARCHAR)"


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct studies: deliveries repeated under one id count once."""
    return table(spark, sf_dir, "estudio").select(
        "id_estudio", "id_paciente", "id_alt_paciente", "tipo_documento", "fecha_estudio"
    ).distinct()


def linked(spark: SparkSession, sf_dir: str, days: int = episodes.WINDOW_DAYS) -> DataFrame:
    return episodes.anchor_episodes(studies(spark, sf_dir), "id_paciente", "fecha_estudio", days)


@registry(_EPISODES + " SELECT id_estudio, id_paciente, strftime(ancla, '%Y-%m-%d') AS ancla FROM linked")
def anchor_episodes(spark, sf_dir):
    """The fixed anchor of every study."""
    return linked(spark, sf_dir).select("id_estudio", "id_paciente", F.date_format("ancla", _DATE).alias("ancla"))


@registry(
    f"SELECT DISTINCT id_paciente, ancla, {keys.hmac16_sql('x', SECRET)} AS id_episodio FROM ("
    + _EPISODES
    + " SELECT id_paciente, strftime(ancla, '%Y-%m-%d') AS ancla, id_paciente || '|' || strftime(ancla, '%Y-%m-%d') AS x FROM linked)"
)
def episode_keys(spark, sf_dir):
    """Distinct episodes with their keyed id."""
    rows = linked(spark, sf_dir).select("id_paciente", "ancla").distinct()
    key = keys.episode_key(F.col("id_paciente"), F.col("ancla"), SECRET)
    return rows.select("id_paciente", F.date_format("ancla", _DATE).alias("ancla"), key.alias("id_episodio"))


_GATE = f"""SELECT id_paciente, strftime(ancla, '%Y-%m-%d') AS ancla, documentos, tipos, {_FALTAN} AS faltantes,
  CASE WHEN documentos > tipos THEN 'asociacion_ambigua' WHEN NOT (e AND l AND c) AND {{closed}} THEN 'estudios_faltantes' END AS motivo,
  CASE WHEN documentos > tipos THEN 'episodio_ambiguo' WHEN NOT (e AND l AND c) AND {{closed}} THEN 'episodio_incompleto' END AS codigo,
  CASE WHEN documentos > tipos THEN 'cuarentena' WHEN NOT (e AND l AND c) THEN '{{state}}' ELSE 'aprobado' END AS estado FROM ep"""


def _gate(spark, sf_dir, closed=True):
    rows = episodes.gate(linked(spark, sf_dir), "id_paciente", "tipo_documento", KINDS, closed)
    return rows.withColumn("ancla", F.date_format("ancla", _DATE))


@registry(_EPISODES + _GATE.format(closed="true", state="cuarentena"))
def episode_gate(spark, sf_dir):
    """Completeness of every episode of a closed run."""
    return _gate(spark, sf_dir)


@registry(_EPISODES + _GATE.format(closed="false", state="pendiente"))
def episode_gate_open_run(spark, sf_dir):
    """The same while the run is open."""
    return _gate(spark, sf_dir, closed=False)


@registry(
    _EPISODES
    + " SELECT CASE WHEN documentos > tipos THEN 'asociacion_ambigua' WHEN NOT (e AND l AND c) THEN 'estudios_faltantes'"
    " ELSE 'aprobado' END AS motivo, count(*) AS episodios, CAST(sum(documentos) AS BIGINT) AS documentos FROM ep GROUP BY 1"
)
def episode_motive_counts(spark, sf_dir):
    """Episodes and documents per motive."""
    rows = _gate(spark, sf_dir).groupBy(F.coalesce("motivo", F.lit("aprobado")).alias("motivo"))
    return rows.agg(F.count("*").alias("episodios"), F.sum("documentos").alias("documentos"))


@registry(
    _EPISODES
    + " SELECT id_paciente, strftime(ancla, '%Y-%m-%d') AS ancla, e AS tiene_ecg, l AS tiene_laboratorio,"
    " c AS tiene_ecocardiograma, e AND l AND c AS completo FROM ep"
)
def episode_presence(spark, sf_dir):
    """Which types an episode has."""
    rows = episodes.presence(linked(spark, sf_dir), "id_paciente", "tipo_documento", KINDS)
    return rows.withColumn("ancla", F.date_format("ancla", _DATE))


@registry(
    _EPISODES
    + " SELECT id_paciente, count(*) AS episodios, CAST(sum(documentos) AS BIGINT) AS documentos,"
    " count(*) FILTER (WHERE e AND l AND c AND documentos = tipos) AS aprobados FROM ep GROUP BY 1"
)
def episodes_per_patient(spark, sf_dir):
    """Episodes, documents and approved episodes of every patient."""
    rows = _gate(spark, sf_dir).groupBy("id_paciente")
    return rows.agg(
        F.count("*").alias("episodios"),
        F.sum("documentos").alias("documentos"),
        F.count_if(F.col("estado") == "aprobado").alias("aprobados"),
    )


_PAIRS = "pares AS (SELECT DISTINCT id_alt_paciente, id_paciente FROM estudio WHERE tipo_documento = 'laboratorio' AND id_alt_paciente IS NOT NULL AND id_paciente IS NOT NULL)"
_BRIDGE = f"""WITH {_PAIRS}, puente AS (
  SELECT id_alt_paciente AS alt, CASE WHEN count(DISTINCT id_paciente) = 1 THEN min(id_paciente) END AS id_paciente,
    count(DISTINCT id_paciente) > 1 AS ambiguo FROM pares GROUP BY 1)"""


def _bridge(spark, sf_dir):
    pairs = table(spark, sf_dir, "estudio").where("tipo_documento = 'laboratorio'")
    return identity.build_bridge(pairs, "id_alt_paciente", "id_paciente")


@registry(_BRIDGE + " SELECT alt, id_paciente, ambiguo FROM puente")
def bridge_build(spark, sf_dir):
    """Alternative key to patient, ambiguous for good when two claim it."""
    return _bridge(spark, sf_dir)


def with_date(docs: DataFrame) -> DataFrame:
    """Stage: a study without a date is an incomplete parse."""
    return docs.withColumn("codigo", F.when(F.col("fecha_estudio").isNull(), F.lit("parseo_incompleto")))


def with_gate(docs: DataFrame) -> DataFrame:
    """Stage: anchor and code of the gate of the episode of the resolved patient."""
    rows = episodes.anchor_episodes(docs, "resuelto", "fecha_estudio")
    state = episodes.gate(rows, "resuelto", "tipo_documento", KINDS).select(
        F.col("resuelto").alias("_p"), F.col("ancla").alias("_a"), F.col("codigo").alias("_c")
    )
    kept = rows.join(state, (rows["resuelto"] == state["_p"]) & (rows["ancla"] == state["_a"]), "left")
    return kept.withColumn("codigo", F.col("_c")).drop("_p", "_a", "_c")


def gated(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Bridge, date and gate: what decides whether a study is approved or in quarantine."""
    bridge = _bridge(spark, sf_dir)
    found = Pipeline().add("identidad", lambda d: identity.resolve(d, bridge, "id_alt_paciente", "id_paciente"))
    return found.add("fecha", with_date).add("episodio", with_gate)


@registry("SELECT 0 AS sin_destino")
def gate_totality(spark, sf_dir):
    """Studies neither approved nor quarantined, of all distinct studies; must be none."""
    docs = studies(spark, sf_dir)
    docs = docs.withColumn("clave", F.to_json(F.struct(*docs.columns)))
    approved, quarantined = gated(spark, sf_dir).run(docs)
    lost = episodes.unaccounted(docs, approved, quarantined, "clave")
    return lost.agg(F.count("*").cast("int").alias("sin_destino"))


_DESTINATIONS = (
    _BRIDGE.replace("WITH", "WITH RECURSIVE", 1)
    + f""", {_STUDIES},
r AS (SELECT s.id_estudio, s.tipo_documento, s.fecha_estudio AS fecha, coalesce(s.id_paciente, p.id_paciente) AS paciente, coalesce(p.ambiguo, false) AS ambiguo
  FROM studies s LEFT JOIN puente p ON s.id_alt_paciente = p.alt),
n AS (SELECT *, row_number() OVER (PARTITION BY paciente ORDER BY fecha) AS k FROM (SELECT DISTINCT paciente, fecha FROM r WHERE paciente IS NOT NULL AND fecha IS NOT NULL)),
walk AS (
  SELECT paciente, fecha, k, fecha AS ancla FROM n WHERE k = 1
  UNION ALL
  SELECT n.paciente, n.fecha, n.k, CASE WHEN n.fecha - w.ancla <= 7 THEN w.ancla ELSE n.fecha END FROM walk w JOIN n ON n.paciente = w.paciente AND n.k = w.k + 1),
a AS (SELECT r.*, w.ancla FROM r LEFT JOIN walk w ON r.paciente = w.paciente AND r.fecha = w.fecha),
c AS (SELECT *, count(*) OVER e - count(DISTINCT tipo_documento) OVER e AS de_mas,
  count(DISTINCT CASE WHEN tipo_documento IN ('ecg', 'laboratorio', 'ecocardiograma') THEN tipo_documento END) OVER e AS hay FROM a WINDOW e AS (PARTITION BY paciente, ancla)),
d AS (SELECT *, CASE WHEN paciente IS NULL THEN CASE WHEN ambiguo THEN 'clave_pii_ambigua' ELSE 'clave_pii_no_resuelta' END WHEN fecha IS NULL THEN 'parseo_incompleto'
  WHEN de_mas > 0 THEN 'episodio_ambiguo' WHEN hay < 3 THEN 'episodio_incompleto' ELSE 'aprobado' END AS destino FROM c)"""
)


@registry(_DESTINATIONS + " SELECT destino, count(*) AS documentos FROM d GROUP BY 1")
def gate_destinations(spark, sf_dir):
    """How many studies are approved or in quarantine under each code."""
    approved, quarantined = gated(spark, sf_dir).run(studies(spark, sf_dir))
    both = approved.select(F.lit("aprobado").alias("destino")).unionByName(quarantined.select(F.col("codigo").alias("destino")))
    return both.groupBy("destino").agg(F.count("*").alias("documentos"))


@registry(
    _BRIDGE
    + ", mitad AS (SELECT id_alt_paciente AS alt, id_paciente FROM pares WHERE id_paciente < '8')"
    ", todo AS (SELECT id_alt_paciente AS alt, id_paciente FROM pares UNION SELECT * FROM mitad)"
    " SELECT alt, CASE WHEN count(DISTINCT id_paciente) = 1 THEN min(id_paciente) END AS id_paciente,"
    " count(DISTINCT id_paciente) > 1 AS ambiguo FROM todo GROUP BY 1"
)
def bridge_upsert(spark, sf_dir):
    """A stored bridge united with new pairs gives the bridge of all pairs."""
    pairs = table(spark, sf_dir, "estudio").where("tipo_documento = 'laboratorio'")
    first = identity.build_bridge(pairs.where("id_paciente < '8'"), "id_alt_paciente", "id_paciente")
    return identity.build_bridge(pairs, "id_alt_paciente", "id_paciente", previous=first)


@registry(
    _BRIDGE
    + """, docs AS (SELECT DISTINCT id_estudio, id_paciente, id_alt_paciente FROM estudio WHERE tipo_documento = 'ecg')
SELECT id_estudio, coalesce(d.id_paciente, p.id_paciente) AS resuelto,
  CASE WHEN coalesce(d.id_paciente, p.id_paciente) IS NOT NULL THEN NULL WHEN p.ambiguo THEN 'clave_pii_ambigua' ELSE 'clave_pii_no_resuelta' END AS codigo
FROM docs d LEFT JOIN puente p ON d.id_alt_paciente = p.alt"""
)
def bridge_resolution(spark, sf_dir):
    """ECGs without patient get the bridge's patient or a code."""
    docs = studies(spark, sf_dir).where("tipo_documento = 'ecg'").select("id_estudio", "id_paciente", "id_alt_paciente")
    out = identity.resolve(docs, _bridge(spark, sf_dir), "id_alt_paciente", "id_paciente")
    return out.select("id_estudio", "resuelto", "codigo")


@registry(
    f"""WITH {_STUDIES}, d AS (SELECT *, CASE WHEN tipo_documento = 'laboratorio' THEN id_paciente END AS propio FROM studies),
w AS (SELECT *, min(propio) OVER x AS a, max(propio) OVER x AS b FROM d
  WINDOW x AS (PARTITION BY id_alt_paciente ORDER BY fecha_estudio, id_estudio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT id_estudio, coalesce(propio, CASE WHEN id_alt_paciente IS NOT NULL AND a = b THEN a END) AS resuelto,
  id_alt_paciente IS NOT NULL AND a IS NOT NULL AS conocido FROM w)
SELECT id_estudio, resuelto, CASE WHEN resuelto IS NOT NULL THEN NULL WHEN conocido THEN 'clave_pii_ambigua' ELSE 'clave_pii_no_resuelta' END AS codigo FROM r"""
)
def bridge_in_order(spark, sf_dir):
    """J01 in strict order: a document sees only pairs registered before it."""
    docs = studies(spark, sf_dir).withColumn("propio", F.when(F.col("tipo_documento") == "laboratorio", F.col("id_paciente")))
    out = identity.resolve_in_order(docs, "id_alt_paciente", "propio", ["fecha_estudio"], "id_estudio", F.year("fecha_estudio"))
    return out.select("id_estudio", "resuelto", "codigo")


_NAME = "upper(trim(regexp_replace(nombre, '\\s+', ' ', 'g')))"
_REST = f"CASE WHEN {_NAME} LIKE '%,%' THEN trim(list_extract(string_split({_NAME}, ','), -1)) ELSE regexp_replace({_NAME}, '^\\S+\\s*', '') END"
_SUR = f"CASE WHEN {_NAME} LIKE '%,%' THEN trim(split_part({_NAME}, ',', 1)) ELSE split_part({_NAME}, ' ', 1) END"


@registry(
    f"""SELECT DISTINCT id_medico,
  {keys.hmac16_sql(f"'medico|' || {_NAME}", SECRET)} AS clave_medico,
  {keys.hmac16_sql("'matricula_medico|' || trim(regexp_replace(lower(trim(matricula)), '^mp\\s*', ''))", SECRET)} AS clave_matricula,
  {keys.hmac16_sql(f"'alt|' || ({_SUR}) || '|' || split_part({_REST}, ' ', 1) || '|1970-01-01'", SECRET)} AS clave_alterna
FROM firma_medico"""
)
def hmac_physician_keys(spark, sf_dir):
    """Keys of physicians, licences and bridge names."""
    rows = table(spark, sf_dir, "firma_medico").select("id_medico", "nombre", "matricula").distinct()
    name, mat = F.col("nombre"), F.col("matricula")
    return rows.select(
        "id_medico",
        keys.physician_key(name, SECRET).alias("clave_medico"),
        keys.licence_key(mat, SECRET).alias("clave_matricula"),
        keys.alternative_key(name, F.lit("1970-01-01"), SECRET).alias("clave_alterna"),
    ).distinct()


@registry(
    f"""SELECT doc_id, {keys.hmac16_sql("'documento|' || sha256(text)", SECRET)} AS clave_documento,
  {keys.hmac16_sql("coalesce(nullif(ltrim(CAST(doc_id AS VARCHAR), '0'), ''), '0')", SECRET)} AS clave_paciente
FROM documents WHERE text IS NOT NULL"""
)
def hmac_document_keys(spark, sf_dir):
    """Keys of content hashes and of national ids."""
    rows = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return rows.select(
        "doc_id",
        keys.document_key(F.sha2("text", 256), SECRET).alias("clave_documento"),
        keys.patient_key(F.col("doc_id").cast("string"), SECRET).alias("clave_paciente"),
    )


def _score_sql(kind):
    return " + ".join(f"CAST(contains(u, '{m}') AS INTEGER)" for m in classify.SIGNATURES[kind])


@registry(
    f"""WITH t AS (SELECT doc_id, upper(coalesce(text, '')) AS u FROM documents),
s AS (SELECT doc_id, {_score_sql('ecg')} AS a, {_score_sql('laboratorio')} AS b, {_score_sql('ecocardiograma')} AS c FROM t),
m AS (SELECT *, greatest(a, b, c) AS g FROM s)
SELECT doc_id, a AS puntaje_ecg, b AS puntaje_laboratorio, c AS puntaje_ecocardiograma,
  CASE WHEN g = 0 OR CAST(a = g AS INTEGER) + CAST(b = g AS INTEGER) + CAST(c = g AS INTEGER) > 1 THEN 'desconocido'
    WHEN a = g THEN 'ecg' WHEN b = g THEN 'laboratorio' ELSE 'ecocardiograma' END AS tipo FROM m"""
)
def detect_type(spark, sf_dir):
    """Layout scores and type of every document."""
    rows = classify.with_kind(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return rows.drop("text")


_DEDUP = """WITH h AS (SELECT doc_id, grupo, sha256(coalesce(text, '')) AS huella FROM documents),
d AS (SELECT *, doc_id <> min(doc_id) OVER (PARTITION BY huella) AS es_copia FROM h)"""


def _deduped(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "grupo", F.coalesce("text", F.lit("")).alias("t"))
    return dedup.first_of_content(docs, F.col("t"), ["doc_id"]).drop("t")


@registry(_DEDUP + " SELECT doc_id, grupo, huella, es_copia FROM d")
def dedup_by_content(spark, sf_dir):
    """The first document of each content; later ones are copies."""
    return _deduped(spark, sf_dir).select("doc_id", "grupo", "huella", "es_copia")


@registry(
    _DEDUP
    + " SELECT grupo, count(*) AS entregados, count(*) FILTER (WHERE NOT es_copia) AS conservados,"
    " count(*) FILTER (WHERE es_copia) AS copias FROM d GROUP BY 1"
)
def dedup_incomplete_groups(spark, sf_dir):
    """What a silent copy takes from its delivery folder."""
    return dedup.incomplete_groups(_deduped(spark, sf_dir), "grupo")


@registry(
    """WITH w AS (SELECT event_id, user_id, event_type, ts,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)
SELECT event_id, user_id, event_type, CAST(sum(CASE WHEN k > 1 AND event_type IS DISTINCT FROM p THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tramo FROM w"""
)
def adjacent_groups(spark, sf_dir):
    """Runs of equal neighbouring events of a user."""
    rows = dedup.adjacent_groups(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "event_type", F.to_date("ts"))
    return rows.select("event_id", "user_id", "event_type", F.col("tramo").cast("long").alias("tramo"))


@registry(
    """WITH g AS (SELECT coalesce(grupo, '__raiz__') AS grupo, count(*) AS filas, count(DISTINCT doc_id) AS documentos FROM documents GROUP BY 1)
SELECT *, (SELECT count(*) FROM documents) AS filas_total FROM g"""
)
def partition_invariants(spark, sf_dir):
    """The groups cover the scan without overlap; their own rows add up to all rows."""
    docs = table(spark, sf_dir, "documents").withColumn("g", F.coalesce("grupo", F.lit(dedup.ROOT_GROUP)))
    groups = docs.groupBy(F.col("g").alias("grupo")).agg(F.count("*").alias("filas"), F.count_distinct("doc_id").alias("documentos"))
    return groups.join(groups.agg(F.sum("filas").alias("filas_total"))).select("grupo", "filas", "documentos", "filas_total")


@registry(
    """WITH f AS (SELECT 'entrada/' || coalesce(grupo || '/', '') || doc_id || CASE doc_id % 5 WHEN 0 THEN '.txt' WHEN 1 THEN '.PDF' ELSE '.pdf' END AS path,
  n_chars * 40000 AS length FROM documents)
SELECT path, length, CASE WHEN NOT regexp_matches(path, '(?i)\\.pdf$') THEN 'formato_no_soportado' WHEN length > 52428800 THEN 'artefacto_sobretamano' END AS codigo,
  CASE WHEN contains(substr(path, 9), '/') THEN split_part(substr(path, 9), '/', 1) ELSE '__raiz__' END AS grupo FROM f"""
)
def scan_routing(spark, sf_dir):
    """Listed files by format, size and folder."""
    suffix = F.when(F.col("doc_id") % 5 == 0, ".txt").when(F.col("doc_id") % 5 == 1, ".PDF").otherwise(".pdf")
    folder = F.coalesce(F.concat("grupo", F.lit("/")), F.lit(""))
    files = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("entrada/"), folder, F.col("doc_id").cast("string"), suffix).alias("path"),
        (F.col("n_chars") * 40000).alias("length"),
    )
    group = dedup.folder_group(F.substr("path", F.lit(9)))
    return dedup.route(files, ["pdf"]).withColumn("grupo", group)

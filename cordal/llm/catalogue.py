"""Queries of the subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordal.llm.leakage import leaked_items
from cordal.llm.mixture import in_order, schedule, share_report
from cordal.llm.mojibake import garbled
from cordal.llm.names import linked_pairs, physician_classes
from cordal.llm.nearest_time import ecg_with_laboratory
from cordal.llm.personal_data import protected_texts
from cordal.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of spellings of one physician, the smaller id first."""
    return linked_pairs(physician_classes(table(spark, sf_dir, "firma_medico")))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per spelling: its class and the number of spellings of that class."""
    classes = physician_classes(table(spark, sf_dir, "firma_medico"))
    sizes = classes.groupBy("persona").agg(F.count("*").alias("grafias"))
    return classes.join(sizes, "persona").select(F.col("id").alias("id_medico"), "persona", "grafias")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ECG with its nearest laboratory study, the smaller id first."""
    pairs = ecg_with_laboratory(table(spark, sf_dir, "medicion_ecg"), table(spark, sf_dir, "estudio"))
    both = F.array_sort(F.array("id_ecg", "id_laboratorio"))
    return pairs.select(both[0].alias("id_estudio_a"), both[1].alias("id_estudio_b")).distinct()


#: Test key only: a production key comes from the caller's secret store.
_TEST_KEY = b"test key, not a secret"


def _protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return protected_texts(table(spark, sf_dir, "texto_seccion_eco"), "id_seccion", "texto", _TEST_KEY)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per personal datum of the echo texts."""
    rows = _protected(spark, sf_dir).select(F.col("id").alias("id_seccion"), F.explode("datos").alias("d"))
    return rows.select("id_seccion", "d.inicio", "d.fin", "d.tipo_entidad").distinct()


def p6_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The echo texts with placeholders and format-preserving pseudonyms."""
    return _protected(spark, sf_dir).select(
        F.col("id").alias("id_seccion"), "texto_seguro", F.size("datos").alias("n_datos")
    )


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "evaluacion"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a held-out item."""
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p7_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks with their share and the character offsets of their stretches."""
    return _leaks(spark, sf_dir)


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of the mix with their deadlines, in the order of the mix."""
    blocks = schedule(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mezcla_objetivo"))
    return in_order(blocks).select("doc_id", "fuente", "repeticion", "tokens", F.round("vence", 3).alias("vence"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of every source of the mix."""
    return share_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mezcla_objetivo"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents decoded with a wrong encoding, with the MD5 of the restored text."""
    return garbled(table(spark, sf_dir, "documents")).select("doc_id", "md5_texto")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with the encodings found and the restored text."""
    return garbled(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_classes, p3_found, p6_found, p6_protected, p7_found, p7_stretches, p8_mix, p8_shares, p9_found, p9_restored)}


def _seconds(alias: str) -> str:
    """Seconds since 1970 of a date and a typed hour, as DuckDB SQL."""
    parts = f"regexp_extract({alias}.hora_estudio, '(?i)^\\s*([0-9]{{1,2}})[:.h]([0-9]{{2}})(?::([0-9]{{2}}))?\\s*(?:hs)?\\s*([ap])?', ['h', 'm', 's', 'x'])"
    hour = f"CAST({parts}.h AS INTEGER)"
    half = f"CASE WHEN lower({parts}.x) = 'p' AND {hour} < 12 THEN 12 WHEN lower({parts}.x) = 'a' AND {hour} = 12 THEN -12 ELSE 0 END"
    clock = f"({hour} + {half}) * 3600 + CAST({parts}.m AS INTEGER) * 60 + coalesce(TRY_CAST({parts}.s AS INTEGER), 0)"
    return f"date_diff('day', DATE '1970-01-01', CAST({alias}.fecha_estudio AS DATE)) * 86400 + {clock}"


def oracle_sql() -> dict[str, str]:
    known = "{a}.id_paciente IS NOT NULL AND {a}.hora_estudio IS NOT NULL AND {a}.fecha_estudio IS NOT NULL"
    return {
        "p3_found": f"""WITH e AS (SELECT DISTINCT id_estudio, id_paciente, {_seconds('m')} AS t FROM medicion_ecg m WHERE {known.format(a='m')}),
l AS (SELECT DISTINCT id_estudio, id_paciente, {_seconds('m')} AS t FROM estudio m WHERE tipo_documento = 'laboratorio' AND {known.format(a='m')}),
p AS (SELECT e.id_estudio AS a, l.id_estudio AS b, row_number() OVER (PARTITION BY e.id_estudio, e.t ORDER BY abs(e.t - l.t), l.t, l.id_estudio) AS k
  FROM e JOIN l ON e.id_paciente = l.id_paciente AND abs(e.t - l.t) <= 5400)
SELECT DISTINCT least(a, b) AS id_estudio_a, greatest(a, b) AS id_estudio_b FROM p WHERE k = 1"""
    }

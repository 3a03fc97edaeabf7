"""Queries p2, p4 and p5: packed fields, units and wide tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordal.operators.packed_fields import clinical_packed_values
from cordal.operators.units import clinical_common_units, differing_units, thousandths
from cordal.operators.wide import filled_numeric_cells, laboratory_wide
from cordal.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of the packed ECG fields and laboratory references."""
    return clinical_packed_values(table(spark, sf_dir, "medicion_ecg"), table(spark, sf_dir, "laboratorio_crudo"))


def _common(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("laboratorio_crudo", "resultado_laboratorio", "medida_eco", "analito_ref")
    return clinical_common_units(*[table(spark, sf_dir, n) for n in names])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose stated unit makes the number differ from the common unit."""
    return differing_units(_common(spark, sf_dir))


def p4_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every measured row with its value in the common unit, where it has one."""
    return _common(spark, sf_dir).select(
        "tabla", "id_fila", "codigo", "unidad_hallada", thousandths(F.col("valor_comun")).alias("valor_mil")
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled numeric cells of the wide laboratory table, with their rows."""
    wide = laboratory_wide(
        table(spark, sf_dir, "resultado_laboratorio"), table(spark, sf_dir, "analito_ref"), ("valor", "fila")
    )
    return filled_numeric_cells(wide)


def p5_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide laboratory table: value, unit, row id and text per code."""
    return laboratory_wide(table(spark, sf_dir, "resultado_laboratorio"), table(spark, sf_dir, "analito_ref"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p4_found, p4_all, p5_found, p5_wide)}


#: Keys of names, sections and units as DuckDB SQL, written apart from the operators.
_PLAIN = "trim(regexp_replace(lower(strip_accents({c})), '\\s+', ' ', 'g'))"


def _plain(c: str) -> str:
    return _PLAIN.format(c=c)


def _name(c: str) -> str:
    return f"regexp_replace(regexp_replace({_plain(c)}, '^[-*•\\s]+', ''), '[\\s.:]+$', '')"


def _section(c: str) -> str:
    key = f"regexp_replace(regexp_replace({_plain(c)}, '^[-\\s]+', ''), '[-\\s:.]+$', '')"
    long = "WHEN 'ionograma serico' THEN 'ionograma' WHEN 'hemostasia y coagulacion' THEN 'hemostasia' WHEN 'orina completa' THEN 'orina'"
    return f"CASE {key} {long} ELSE {key} END"


def _unit(c: str) -> str:
    key = f"strip_accents(lower(translate({c}, 'µμ³²', 'uu32')))"
    for pattern, new in (("\\s+", ""), ("^[(\\[]+", ""), ("[)\\]]+$", ""), ("\\.+$", ""), ("^x?10(?:\\*|e|\\^)([0-9]+)", "10^\\1"), ("^mc(g|mol|kat|l|m)", "u\\1")):
        key = f"regexp_replace({key}, '{pattern}', '{new}', 'g')"
    return key


_TAIL = "'^(.*\\S)\\s*(?:\\[([^\\[\\]]+)\\]|\\(([^()]+)\\)|\\sen\\s+(\\S.*?))[\\s.:]*$'"
#: Units built from prefix, measure and divisor, apart from the operator's list of spellings.
_ALIAS = """pre(p, pf) AS (VALUES ('', 1e0), ('m', 1e-3), ('u', 1e-6), ('n', 1e-9), ('p', 1e-12), ('mili', 1e-3), ('micro', 1e-6), ('nano', 1e-9), ('pico', 1e-12)),
len(l, lf) AS (VALUES ('mm', 1e0), ('milimetros', 1e0), ('cm', 1e1), ('cms', 1e1), ('centimetros', 1e1), ('m', 1e3), ('mts', 1e3), ('metros', 1e3)),
vol(v, vf) AS (VALUES ('/ul', 1e0), ('/mm3', 1e0), ('/l', 1e-6)),
a(unidad, magnitud, base) AS (
  SELECT p || g || d, 'mass', pf * 100 / df FROM pre, (VALUES ('g'), ('gr')) AS g(g), (VALUES ('/l', 1e0), ('/dl', 1e-1), ('%', 1e-1), ('/ml', 1e-3)) AS d(d, df)
  UNION ALL SELECT p || x, 'mole', pf * 1000 FROM pre, (VALUES ('mol/l'), ('moles/l')) AS x(x) UNION ALL SELECT p || 'm', 'mole', pf * 1000 FROM pre WHERE length(p) = 1
  UNION ALL SELECT 'meq/l', 'charge', 1 UNION ALL SELECT p || 'kat/l', 'activity', pf * 6e7 FROM pre UNION ALL SELECT x, 'activity', 1 FROM (VALUES ('u/l'), ('ui/l')) AS x(x)
  UNION ALL SELECT p || x || d, 'hormone', pf * 1000 / df FROM pre, (VALUES ('ui'), ('u')) AS x(x), (VALUES ('/l', 1e0), ('/ml', 1e-3)) AS d(d, df) WHERE p <> '' OR x = 'ui'
  UNION ALL SELECT n || v, 'count', nf * vf FROM vol, (VALUES ('', 1e0), ('cel', 1e0), ('por', 1e0), ('k', 1e3), ('mil', 1e3), ('miles', 1e3), ('10^3', 1e3), ('m', 1e6), ('mill', 1e6), ('millones', 1e6), ('10^6', 1e6), ('10^9', 1e9), ('10^12', 1e12), ('g', 1e9), ('t', 1e12)) AS n(n, nf)
  UNION ALL SELECT 'pormm3', 'count', 1
  UNION ALL SELECT u, 'part', f FROM (VALUES ('%', 1e0), ('porciento', 1e0), ('porc', 1e0), ('‰', 1e-1), ('pormil', 1e-1), ('fraccion', 1e2), ('fracc', 1e2), ('l/l', 1e2)) AS u(u, f)
  UNION ALL SELECT l, 'length', lf FROM len UNION ALL SELECT l || '/' || t, 'speed', lf / 10 FROM len, (VALUES ('s'), ('seg')) AS t(t)
  UNION ALL SELECT l || '2', 'area', lf * lf / 100 FROM len UNION ALL SELECT l || '/' || t, 'settling', lf FROM len, (VALUES ('h'), ('hora'), ('1rahora')) AS t(t) UNION ALL SELECT 'mm1rahora', 'settling', 1
  UNION ALL SELECT u, 'volume', f FROM (VALUES ('ml', 1e0), ('cc', 1e0), ('cm3', 1e0), ('l', 1e3), ('lts', 1e3), ('litros', 1e3)) AS u(u, f)
  UNION ALL SELECT u, 'pressure', f FROM (VALUES ('mmhg', 1e0), ('mmdehg', 1e0), ('kpa', 7.50062e0)) AS u(u, f)
  UNION ALL SELECT u, 'time', f FROM (VALUES ('s', 1e0), ('seg', 1e0), ('segundos', 1e0), ('min', 6e1), ('minutos', 6e1)) AS u(u, f)
  UNION ALL SELECT u, 'cell volume', 1 FROM (VALUES ('fl'), ('um3')) AS u(u))"""
_CHARGE = "CASE WHEN codigo IN ('CAL', 'MAG') THEN 2 ELSE 1 END"
_NAMES = f"""{_ALIAS},
r AS (SELECT codigo, ambito, coalesce({_section('seccion')}, '') AS sec, {_unit('unidad_comun')} AS comun, masa_molar / 10 AS m, unnest(list_prepend(nombre, coalesce(sinonimos, []))) AS n FROM analito_ref),
nombres AS (SELECT DISTINCT codigo, ambito, sec, {_name('n')} AS k FROM r),
c AS (SELECT DISTINCT codigo, m, a.magnitud AS mag, CASE a.magnitud WHEN 'mole' THEN base * m WHEN 'charge' THEN base * m / {_CHARGE} ELSE base END AS cb
  FROM r JOIN a ON r.comun = a.unidad WHERE (a.magnitud <> 'hormone' OR codigo = 'TSH') AND (a.magnitud <> 'mole' OR m IS NOT NULL)),
f0 AS (SELECT DISTINCT codigo, a.unidad, CASE a.magnitud WHEN 'mole' THEN base * m WHEN 'charge' THEN base * m / {_CHARGE} ELSE base END / cb AS factor
  FROM c JOIN a ON CASE WHEN a.magnitud IN ('mole', 'charge') THEN 'mass' ELSE a.magnitud END = CASE WHEN mag IN ('mole', 'charge') THEN 'mass' ELSE mag END),
f AS (SELECT * FROM f0 WHERE factor IS NOT NULL)"""
_ROWS = f"""filas AS (
  SELECT 'laboratorio_crudo' AS tabla, id_fila, prueba AS nom, seccion AS s, resultado AS t, CAST(NULL AS DOUBLE) AS d, unidades AS u, 'laboratorio' AS amb FROM laboratorio_crudo
  UNION ALL SELECT 'resultado_laboratorio', id_resultado, analito, seccion, valor_texto, valor_num, unidad, 'laboratorio' FROM resultado_laboratorio
  UNION ALL SELECT 'medida_eco', id_medida, nombre, '', valor, NULL, unidad, 'eco' FROM medida_eco),
p AS (SELECT *, regexp_extract(t, '^\\s*(?:(?i:aprox)[.]?\\s*)?([-+]?[0-9]+(?:[.,][0-9]+)?)\\s*(.*?)\\s*$', ['n', 'c']) AS g, regexp_extract(nom, {_TAIL}, ['b', 'x', 'y', 'z']) AS q FROM filas),
v AS (SELECT *, coalesce(d, TRY_CAST(replace(g.n, ',', '.') AS DOUBLE)) AS valor, CASE WHEN d IS NULL THEN regexp_replace(g.c, '^(?i:en)\\s+', '') END AS cola,
  coalesce({_section('s')}, CASE WHEN s = '' THEN '' END) AS sec, {_name('nom')} AS k1, {_name('q.b')} AS k2 FROM p),
w AS (SELECT v.*, coalesce(n1.codigo, n2.codigo) AS codigo, coalesce(nullif({_unit('u')}, ''), nullif({_unit('cola')}, ''),
  CASE WHEN n1.codigo IS NULL THEN nullif({_unit("q.x || q.y || q.z")}, '') END) AS unidad_hallada
  FROM v LEFT JOIN nombres n1 ON n1.ambito = amb AND n1.sec = v.sec AND n1.k = k1 LEFT JOIN nombres n2 ON n2.ambito = amb AND n2.sec = v.sec AND n2.k = k2)"""
_MIL = "CAST(round_even(round(valor * factor * 1000, 6), 0) AS BIGINT)"

_P5 = f"""WITH {_NAMES}, v AS (SELECT id_estudio, id_resultado, {_section('seccion')} AS sec, {_name('analito')} AS k1, {_name(f"regexp_extract(analito, {_TAIL}, 1)")} AS k2
  FROM resultado_laboratorio WHERE valor_num IS NOT NULL AND id_estudio IS NOT NULL)
SELECT id_estudio, coalesce(n1.codigo, n2.codigo) AS codigo, max(id_resultado) AS id_resultado FROM v
LEFT JOIN nombres n1 ON n1.ambito = 'laboratorio' AND n1.sec = v.sec AND n1.k = k1 LEFT JOIN nombres n2 ON n2.ambito = 'laboratorio' AND n2.sec = v.sec AND n2.k = k2
WHERE coalesce(n1.codigo, n2.codigo) IS NOT NULL GROUP BY 1, 2"""

_INTEGERS = """SELECT DISTINCT '{campo}' AS campo, CAST(id_estudio AS BIGINT) AS id_fila, {campo} AS t FROM medicion_ecg WHERE regexp_matches({campo}, '[0-9][^0-9]+[0-9]')"""
_P2 = f"""WITH e AS ({_INTEGERS.format(campo='qt_qtc')} UNION ALL {_INTEGERS.format(campo='ejes')}),
n AS (SELECT *, regexp_replace(regexp_replace(t, '["''()]', '', 'g'), '(?i)n/d|s/d|n/a', 'x', 'g') AS b FROM e),
q AS (SELECT *, list_filter(['/', ';', '|', chr(9), chr(10), chr(92), '⁄', ','], lambda d: contains(b, d))[1] AS d FROM n),
s AS (SELECT *, CASE WHEN d IS NOT NULL THEN string_split(b, d) ELSE list_filter(regexp_extract_all(regexp_replace(b, '([0-9])\\s*-\\s+|([0-9])-([0-9])', '\\1\\2 \\3', 'g'), '[-−]?[0-9]+'), lambda x: true) END AS k FROM q),
x AS (SELECT campo, id_fila, unnest(k) AS v, generate_subscripts(k, 1) AS posicion, len(list_filter(k, lambda y: regexp_matches(y, '[0-9]'))) AS c FROM s),
i AS (SELECT campo, id_fila, CAST(posicion AS INTEGER) AS posicion, replace(regexp_extract(v, '[-−]?[0-9]+'), '−', '-') AS valor FROM x WHERE c > 1 AND regexp_matches(v, '[0-9]')),
l AS (SELECT DISTINCT id_fila, trim(valores_referencia, ' ') AS t FROM laboratorio_crudo WHERE valores_referencia IS NOT NULL),
lq AS (SELECT id_fila, list_transform(regexp_extract_all(t, '"((?:[^"]|"")*)"', 1), lambda z: replace(z, '""', '"')) AS k FROM l WHERE regexp_matches(t, '^"([^"]|"")*"(\\s*[;,]\\s*"([^"]|"")*")+$')),
lu AS (SELECT id_fila, string_split(replace(t, chr(13), ''), list_filter([chr(10), chr(9), '|', ';', '/'], lambda d: contains(t, d))[1]) AS k FROM l
  WHERE NOT starts_with(t, '"') AND regexp_matches(t, '[|;/\\t\\n]') AND NOT regexp_matches(t, '/mm3|[(]H/M[)]')),
lk AS (SELECT * FROM lq UNION ALL SELECT * FROM lu),
lx AS (SELECT id_fila, unnest(k) AS v, generate_subscripts(k, 1) AS posicion, len(list_filter(k, lambda y: regexp_matches(y, '[0-9]'))) AS c FROM lk)
SELECT * FROM i UNION ALL SELECT 'valores_referencia', id_fila, CAST(posicion AS INTEGER), trim(v) FROM lx WHERE c > 1 AND regexp_matches(v, '[0-9]')"""


#: The laboratory codes of the attribute table, which are the columns of the wide one.
_CODES = (
    "ALB B12 BIT CAL CLO COL CRE DDI ERI ESR FAL FER FIB FOS GLU GOT GPT HBA HDL HEM HGB HIE KPT LDL LEU LIP MAG "
    "NEA NEP PCR PLA POT PRT RET SOD T4L TP TRI TRO TSH UCR UGL UPR URE URI VCM VID "
).split()


def _cells(code: str) -> str:
    """The four columns of a code: number, its unit and row, text."""
    number, words = f"c = '{code}' AND valor_num IS NOT NULL", f"c = '{code}' AND valor_texto IS NOT NULL"
    return (
        f"""max_by(valor_num, (id_resultado, valor_num)) FILTER ({number}) AS "{code}", (max_by({{'u': unidad}}, (id_resultado, valor_num)) FILTER ({number})).u AS "{code}_unidad","""
        f""" max(id_resultado) FILTER ({number}) AS "{code}_fila", max_by(valor_texto, (id_resultado, valor_texto)) FILTER ({words}) AS "{code}_texto\""""
    )


_WIDE = f"""WITH {_NAMES}, v AS (SELECT *, {_section('seccion')} AS sec, {_name('analito')} AS k1, {_name(f"regexp_extract(analito, {_TAIL}, 1)")} AS k2
  FROM resultado_laboratorio WHERE id_estudio IS NOT NULL AND (valor_num IS NOT NULL OR valor_texto IS NOT NULL)),
w AS (SELECT v.*, coalesce(n1.codigo, n2.codigo) AS c FROM v LEFT JOIN nombres n1 ON n1.ambito = 'laboratorio' AND n1.sec = v.sec AND n1.k = k1 LEFT JOIN nombres n2 ON n2.ambito = 'laboratorio' AND n2.sec = v.sec AND n2.k = k2)
SELECT id_estudio, {', '.join(map(_cells, _CODES))} FROM w WHERE c IS NOT NULL GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _P2,
        "p4_found": f"WITH {_NAMES}, {_ROWS} SELECT DISTINCT tabla, id_fila, {_MIL} AS valor_mil FROM w JOIN f ON f.codigo = w.codigo AND f.unidad = w.unidad_hallada WHERE valor IS NOT NULL AND abs(factor - 1) > 1e-9",
        "p4_all": f"WITH {_NAMES}, {_ROWS} SELECT tabla, id_fila, w.codigo, unidad_hallada, {_MIL} AS valor_mil FROM w LEFT JOIN f ON f.codigo = w.codigo AND f.unidad = w.unidad_hallada",
        "p5_found": _P5,
        "p5_wide": _WIDE,
    }

"""Quantities recorded in different units, brought to one common unit per analyte.

Native plan throughout: the number and its trailing unit are cut out with
``regexp_extract``, unit spellings are normalised by a join with an alias table,
the stated unit is the first of unit field, unit in the value text, unit in the
name text and source default, then ``value * factor + offset`` is applied.
Joined sides are reference tables and distinct spellings; their size is counted
before a broadcast, so only the measured table is scanned, and of it only the
found cases are shuffled.

Defined results
---------------
* null or empty value, words, limits such as ``< 10``: ``valor_comun`` null.
* no stated unit and no source default: ``unidad_hallada`` and ``valor_comun`` null.
* a unit that does not fit the analyte's quantity: ``valor_comun`` null.
* unknown analyte or section: kept, with null ``codigo`` and ``valor_comun``.
* comma and point are decimal marks, never thousands marks.
* a number behind a hedge (``aprox. 29 MM``) is a plain number.
* repeated rows stay repeated; ``differing_units`` reports each of them once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cordal.operators.analytes import analyte_names, name_base, name_key, name_tail, section_key, unit_key
from cordal.session import bounded, lookup

#: Quantity, factor to the quantity's base unit, spellings (as unit keys).
#: Base units: mg/dL, mmol/L, /uL, %, mm, cm/s, cm2, mL, mmHg, mm/h, s, fL, U/L, mUI/L.
UNITS = [
    ("mass", 1.0, "mg/dl mg% mgr/dl mgr%"),
    ("mass", 100.0, "g/l gr/l"),
    ("mass", 1000.0, "g/dl g% gr/dl gr%"),
    ("mass", 0.1, "mg/l ug/ml mgr/l"),
    ("mass", 0.001, "ug/dl ug%"),
    ("mass", 0.0001, "ug/l ng/ml"),
    ("mass", 0.000001, "ng/dl ng%"),
    ("mass", 0.0000001, "ng/l pg/ml"),
    ("mole", 1000.0, "mol/l"),
    ("mole", 1.0, "mmol/l milimol/l mm milimoles/l"),
    ("mole", 0.001, "umol/l micromol/l um"),
    ("mole", 0.000001, "nmol/l nanomol/l nm"),
    ("mole", 0.000000001, "pmol/l picomol/l pm"),
    ("charge", 1.0, "meq/l"),
    ("count", 1.0, "/ul /mm3 cel/mm3 pormm3 cel/ul"),
    ("count", 1000.0, "10^3/ul 10^3/mm3 k/ul mil/mm3 miles/mm3 g/l 10^9/l"),
    ("count", 1000000.0, "10^6/ul 10^6/mm3 m/ul mill/mm3 millones/mm3 t/l 10^12/l"),
    ("part", 1.0, "% porciento porc"),
    ("part", 0.1, "‰ pormil"),
    ("part", 100.0, "fraccion fracc l/l"),
    ("length", 1.0, "mm milimetros"),
    ("length", 10.0, "cm cms centimetros"),
    ("length", 1000.0, "m mts metros"),
    ("speed", 1.0, "cm/s cm/seg cms/seg cms/s"),
    ("speed", 100.0, "m/s m/seg mts/seg mts/s"),
    ("area", 1.0, "cm2 cms2"),
    ("area", 0.01, "mm2"),
    ("volume", 1.0, "ml cc cm3"),
    ("volume", 1000.0, "l lts litros"),
    ("pressure", 1.0, "mmhg mmdehg"),
    ("pressure", 7.50062, "kpa"),
    ("settling", 1.0, "mm/h mm/hora mm1rahora mm/1rahora"),
    ("settling", 10.0, "cm/h cm/hora"),
    ("time", 1.0, "s seg segundos"),
    ("time", 60.0, "min minutos"),
    ("cell volume", 1.0, "fl um3"),
    ("activity", 1.0, "u/l ui/l"),
    ("activity", 60.0, "ukat/l"),
    ("activity", 0.06, "nkat/l"),
    ("hormone activity", 1.0, "mui/l mu/l uui/ml uu/ml"),
    ("hormone activity", 1000.0, "ui/l"),
]

#: Ion charge by analyte code, where it is not 1.
CHARGES = {"CAL": 2.0, "MAG": 2.0}

#: Words and marks in front of a number that say it is rounded; a limit (< or >) is none of them.
HEDGES = r"aprox(?:imad[oa](?:mente)?)?|alrededor\s+de|cerca\s+de|unos|unas|circa|ca|~|≈|±"
_NUMBER = rf"^\s*(?:(?i:{HEDGES})[.:]?\s*)?([-−+]?[0-9]+(?:[.,][0-9]+)?)\s*(.*?)\s*$"


def unit_aliases(spark: SparkSession) -> DataFrame:
    """(unidad_key, magnitud, a_base, orden): a unit key may serve several quantities."""
    rows = [(key, quantity, factor, n) for n, (quantity, factor, keys) in enumerate(UNITS) for key in keys.split()]
    return spark.createDataFrame(rows, "unidad_key string, magnitud string, a_base double, orden int")


def unit_factors(ref: DataFrame, extra: DataFrame | None = None, charges: dict[str, float] = CHARGES) -> DataFrame:
    """(codigo, unidad_key, factor, desplazamiento): stated unit to common unit.

    Molar and charge units are tied to mass units by ``masa_molar`` (g/mol) and
    ``charges``. Where the common unit is a key of several quantities, the first
    of them in ``UNITS`` that has a factor for the analyte counts ("mm" is molar
    only with a molar mass, "ui/l" an enzyme's unit unless the common one is of a
    hormone). ``extra`` may add rows of the same columns, such as affine conversions.
    """
    spark = ref.sparkSession
    alias = F.broadcast(unit_aliases(spark))  # a constant of this module, under 150 rows
    molar = F.col("masa_molar") / 10.0
    charge = reduce(lambda c, kv: F.when(F.col("codigo") == kv[0], F.lit(kv[1])).otherwise(c), charges.items(), F.lit(1.0))
    scale = (
        F.when(F.col("magnitud") == "mole", F.col("a_base") * molar)
        .when(F.col("magnitud") == "charge", F.col("a_base") * molar / charge)
        .otherwise(F.col("a_base"))
    )
    family = F.when(F.col("magnitud").isin("mole", "charge"), "mass").otherwise(F.col("magnitud"))
    base = ref.select("codigo", unit_key(F.col("unidad_comun")).alias("comun_key"), "masa_molar")
    common = base.join(alias, base["comun_key"] == alias["unidad_key"]).select(
        "codigo", "masa_molar", scale.alias("comun_a_base"), family.alias("familia"), "orden"
    )
    own = F.min_by(F.struct("masa_molar", "comun_a_base", "familia"), "orden").alias("propia")
    common = common.where("comun_a_base IS NOT NULL").groupBy("codigo").agg(own).select("codigo", "propia.*")
    stated = common.join(alias.drop("orden").withColumn("familia", family), "familia")
    stated = stated.withColumn("a_comun", scale / F.col("comun_a_base")).where("a_comun IS NOT NULL")
    known = stated.groupBy("codigo", "unidad_key").agg(F.min("a_comun").alias("factor"))
    known = known.withColumn("desplazamiento", F.lit(0.0))
    return known if extra is None else known.unionByName(extra)


def to_common_unit(
    df: DataFrame,
    ref: DataFrame,
    *,
    id_col: str,
    name_col: str,
    value_cols: list[str],
    unit_col: str,
    scope: str,
    section_col: str | None = None,
    source_default: Column | None = None,
) -> DataFrame:
    """id_fila, codigo, valor, unidad_hallada, factor, desplazamiento, valor_comun.

    ``value_cols`` are tried in order; text values may carry a unit behind the
    number (``9 mg/dL``, ``9 en mg/dL``, ``9 (mg/dL)``). Spellings of names and
    units repeat endlessly, so their keys are made once per distinct spelling
    and joined back; a row itself only has its number cut out.
    """
    rows = _measured(df, id_col, name_col, value_cols, unit_col, section_col, source_default)
    return _converted(rows.withColumn("_ambito", F.lit(scope)), ref, {scope} if section_col else set()).drop("_ambito")


def _measured(
    df: DataFrame, id_col: str, name_col: str, value_cols: list[str], unit_col: str, section_col: str | None = None, source_default: Column | None = None
) -> DataFrame:
    """The columns of a measured table under common names."""
    kinds = dict(df.dtypes)
    numeric = [F.col(c).cast("double") for c in value_cols if kinds[c] in ("double", "float", "int", "bigint")]
    textual = [F.col(c).cast("string") for c in value_cols if kinds[c] == "string"]
    typed = F.coalesce(*numeric) if numeric else F.lit(None).cast("double")
    text = F.coalesce(*textual) if textual else F.lit(None).cast("string")
    return df.select(
        F.col(id_col).cast("long").alias("id_fila"),
        F.col(name_col).cast("string").alias("_nombre"),
        (F.col(section_col).cast("string") if section_col else F.lit("")).alias("_seccion"),
        F.when(typed.isNull(), text).alias("_texto"),
        typed.alias("_tipado"),
        F.col(unit_col).cast("string").alias("_unidad"),
        (F.lit(None).cast("string") if source_default is None else source_default).alias("_defecto"),
    )


def _converted(rows: DataFrame, ref: DataFrame, sectioned: set[str]) -> DataFrame:
    """``rows`` of one or several tables in common units; names are looked up within ``_ambito``.

    ``sectioned`` are the scopes whose names belong to a section. The side tables
    are made once for all tables.
    """
    # digits and marks alone are a number; everything else goes through the pattern
    bare = F.translate("_texto", "0123456789.,", "") == ""
    as_number = lambda c: F.translate(c, ",−", ".-").try_cast("double")
    tail = F.regexp_replace(F.regexp_extract("_texto", _NUMBER, 2), r"^(?i:en)\s+", "")
    rows = rows.withColumn(
        "valor",
        F.coalesce(
            "_tipado",
            F.when(bare, as_number(F.col("_texto"))).otherwise(as_number(F.regexp_extract("_texto", _NUMBER, 1))),
        ),
    ).withColumn("_cola", F.when(~bare, F.nullif(tail, F.lit(""))))

    with_section = F.col("_ambito").isin(list(sectioned)) if sectioned else F.lit(False)
    names = analyte_names(ref).withColumnRenamed("ambito", "_ambito")
    names = bounded(names.withColumn("seccion_key", F.when(with_section, F.col("seccion_key")).otherwise(F.lit(""))))
    full = names.select("_ambito", "seccion_key", F.col("nombre_key").alias("_k"), F.col("codigo").alias("_c1"))
    base = names.select("_ambito", "seccion_key", F.col("nombre_key").alias("_kb"), F.col("codigo").alias("_c2"))
    spelled = rows.select("_ambito", "_nombre", "_seccion").distinct()
    spelled = (
        spelled.withColumn("seccion_key", F.when(with_section, section_key(F.col("_seccion"))).otherwise(F.lit("")))
        .withColumn("_k", name_key(F.col("_nombre")))
        .withColumn("_kb", name_key(name_base(F.col("_nombre"))))
        .withColumn("_u3", unit_key(name_tail(F.col("_nombre"))))
        .join(full, ["_ambito", "seccion_key", "_k"], "left")
        .join(base, ["_ambito", "seccion_key", "_kb"], "left")
        .select(
            "_ambito",
            "_nombre",
            "_seccion",
            F.coalesce("_c1", "_c2").alias("codigo"),
            F.when(F.col("_c1").isNull(), F.col("_u3")).alias("_u3"),  # a whole known name holds no unit
        )
    )
    units = rows.select("_unidad").distinct().withColumn("_u1", F.nullif(unit_key(F.col("_unidad")), F.lit("")))
    rows = rows.join(lookup(spelled), ["_ambito", "_nombre", "_seccion"], "left").join(lookup(units), "_unidad", "left")
    rows = rows.withColumn(
        "unidad_hallada",
        F.coalesce("_u1", F.when(F.col("_cola").isNotNull(), unit_key(F.col("_cola"))), "_u3", unit_key(F.col("_defecto"))),
    )
    factors = lookup(unit_factors(ref)).withColumnRenamed("unidad_key", "unidad_hallada")
    others = [c for c in rows.columns if c in ("tabla", "_ambito")]
    return rows.join(factors, ["codigo", "unidad_hallada"], "left").select(
        *others,
        "id_fila",
        "codigo",
        "valor",
        "unidad_hallada",
        "factor",
        "desplazamiento",
        (F.col("valor") * F.col("factor") + F.col("desplazamiento")).alias("valor_comun"),
    )


def thousandths(value: Column) -> Column:
    """``value`` times 1000 as an integer, ties to even after removing float noise."""
    return F.bround(F.round(value * 1000, 6), 0).cast("long")


def clinical_common_units(lab: DataFrame, results: DataFrame, echo: DataFrame, ref: DataFrame) -> DataFrame:
    """All three tables of measured values in common units, with ``tabla`` in front."""
    parts = [
        ("laboratorio_crudo", "laboratorio", _measured(lab, "id_fila", "prueba", ["resultado"], "unidades", "seccion")),
        ("resultado_laboratorio", "laboratorio", _measured(results, "id_resultado", "analito", ["valor_num", "valor_texto"], "unidad", "seccion")),
        ("medida_eco", "eco", _measured(echo, "id_medida", "nombre", ["valor"], "unidad")),
    ]
    rows = reduce(DataFrame.unionByName, [d.withColumns({"tabla": F.lit(t), "_ambito": F.lit(a)}) for t, a, d in parts])
    return _converted(rows, ref, {"laboratorio"}).drop("_ambito")


def differing_units(common: DataFrame) -> DataFrame:
    """tabla, id_fila, valor_mil of the rows whose stated unit changes the number."""
    changed = F.col("valor_comun").isNotNull() & (
        (F.abs(F.col("factor") - 1.0) > 1e-9) | (F.col("desplazamiento") != 0.0)
    )
    return (
        common.where(changed).select("tabla", "id_fila", thousandths(F.col("valor_comun")).alias("valor_mil")).distinct()
    )

"""Packed fields, units and wide tables: edge cases and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from cordal.operators.packed_fields import band_rule, integer_rule, split_packed
from cordal.operators.units import differing_units, to_common_unit, thousandths
from cordal.operators.wide import filled_numeric_cells, laboratory_wide, to_wide

REF = [
    ("GLU", "laboratorio", "Glucosa", ["Glucemia"], "QUIMICA CLINICA", "mg/dL", 180.156),
    ("UGL", "laboratorio", "Glucosa", ["Glucosuria"], "ORINA", "mg/dL", 180.156),
    ("SOD", "laboratorio", "Sodio", ["Na+"], "IONOGRAMA", "mmol/L", 22.99),
    ("LEU", "laboratorio", "Leucocitos", [], "HEMATOLOGIA", "/uL", None),
    ("NEA", "laboratorio", "Neutrófilos absolutos", ["Neutrófilos (valor absoluto)"], "HEMATOLOGIA", "/uL", None),
    ("AO", "eco", "AO", ["Raíz aórtica"], None, "mm", None),
]
REF_SCHEMA = "codigo string, ambito string, nombre string, sinonimos array<string>, seccion string, unidad_comun string, masa_molar double"


@pytest.fixture(scope="module")
def ref(spark):
    return spark.createDataFrame(REF, REF_SCHEMA)


def values_of(spark, texts, kind):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k long, campo string, posicion string")  # clashing names
    out = split_packed(df, "k", "campo", "c", kind).collect()
    return {i: sorted((r.posicion, r.valor) for r in out if r.id_fila == i) for i in range(len(texts))}


def test_integers(spark):
    cases = {
        "310/404": [(1, "310"), (2, "404")],
        "12 - -65 - 74": [(1, "12"), (2, "-65"), (3, "74")],
        "310-427": [(1, "310"), (2, "427")],
        "10 −30 32": [(1, "10"), (2, "-30"), (3, "32")],
        '"9";"-8";"7"': [(1, "9"), (2, "-8"), (3, "7")],
        "18;;40": [(1, "18"), (3, "40")],
        "--/14/46": [(2, "14"), (3, "46")],
        "16, n/d, 9": [(1, "16"), (3, "9")],
        "QT: 310 ms; QTc: 447 ms": [(1, "310"), (2, "447")],
        "P 9 R -8 T 1": [(1, "9"), (2, "-8"), (3, "1")],
        "312/": [], "489": [], "QT 9": [], "---": [], "": [], "   ": [],
    }
    got = values_of(spark, [*cases, None], "integers")
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert got[len(cases)] == []


def test_bands(spark):
    cases = {
        "H: 10 - 20 / M: hasta 5,4": [(1, "H: 10 - 20"), (2, "M: hasta 5,4")],
        "Ayunas: > 9\tPosprandial = 1-2": [(1, "Ayunas: > 9"), (2, "Posprandial = 1-2")],
        "1er trim.: 1 - 2 / -- / 3er trim.: <= 4": [(1, "1er trim.: 1 - 2"), (3, "3er trim.: <= 4")],
        '"H: 1 - 2 | repetir","M: 3 (valor ""límite"")"': [(1, "H: 1 - 2 | repetir"), (2, 'M: 3 (valor "límite")')],
        "0,92 - 2,36 (adultos, ayuno de 8 h)": [], "hasta 1,62, sin ayuno": [], '"0,92 - 2,36"': [], "0,9 - 2 /mm3": [],
    }
    got = values_of(spark, list(cases), "bands")
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_rules_are_total():
    rnd = random.Random(7)
    for _ in range(500):
        text = "".join(rnd.choice("9w x/;|,\t\n-*\"'()#b:") for _ in range(rnd.randrange(12)))
        for rule in (integer_rule, band_rule):
            mode, _, places = rule(text)
            assert mode in ("single", "integers", "quoted", "split")
            assert len({p for p, _ in places}) == len(places)


def test_repeated_rows_and_very_long_text(spark):
    long = "/".join(str(i) for i in range(5000))
    df = spark.createDataFrame([(1, long), (1, long), (2, None)], "k long, t string")
    out = split_packed(df, "k", "t", "c", "integers")
    assert out.count() == 5000
    assert out.agg(F.max("posicion")).first()[0] == 5000


def common(spark, ref, rows):
    df = spark.createDataFrame(rows, "id long, nombre string, seccion string, valor string, unidad string, codigo string")
    out = to_common_unit(df, ref, id_col="id", name_col="nombre", value_cols=["valor"], unit_col="unidad", scope="laboratorio", section_col="seccion")
    return {r.id_fila: r for r in out.withColumn("mil", thousandths(F.col("valor_comun"))).collect()}


def test_units(spark, ref):
    rows = [
        (1, "Glucosa", "-QUÍMICA CLÍNICA-", "5,5", "mmol/L", "x"),
        (2, "* glucemia..", "Quimica  clinica", "0.9 G/L.", None, "x"),
        (3, "Sodio [mg/dL]", "IONOGRAMA SERICO", "310", None, "x"),
        (4, "Leucocitos", "HEMATOLOGIA", "7.5", "G/L.", "x"),
        (5, "Neutrófilos (valor absoluto)", "HEMATOLOGIA", "4,2", "x10^3/µL", "x"),
        (6, "Glucosa", "QUIMICA CLINICA", "< 10", "g/l", "x"),
        (7, "Glucosa", "QUIMICA CLINICA", "100", None, "x"),
        (8, "Desconocido", "QUIMICA CLINICA", "1", "g/l", "x"),
        (9, None, None, None, None, None),
        (10, "Sodio", "IONOGRAMA", "140", "mEq/l", "x"),
        (11, "Glucosa", "QUIMICA CLINICA", "1.000", "mg/dl", "x"),
        (12, "Glucosa", "QUIMICA CLINICA", "5", "mm", "x"),
        (13, "Glucosa", "QUIMICA CLINICA", "Hemolizado", "mg/dl", "x"),
    ]
    got = common(spark, ref, rows)
    assert got[1].mil == round(5.5 * 18.0156 * 1000)
    assert got[2].mil == 90_000
    assert got[3].mil == round(310 * 10 / 22.99 * 1000)
    assert got[4].mil == 7_500_000
    assert got[5].mil == 4_200_000
    assert got[6].mil is None and got[7].mil is None and got[8].codigo is None and got[9].mil is None
    assert got[10].factor == pytest.approx(1)
    assert got[11].mil == 1000  # a point is a decimal mark
    assert got[12].mil == round(5 * 18.0156 * 1000)  # mM, not millimetres
    assert got[13].mil is None


def test_units_found_once(spark, ref):
    rows = [(1, "Glucosa", "ORINA", "1", "g/l", "")] * 2 + [(2, "Glucosa", "ORINA", "1", "mg/dl", "")]
    df = spark.createDataFrame(rows, "id long, nombre string, seccion string, valor string, unidad string, x string")
    out = to_common_unit(df, ref, id_col="id", name_col="nombre", value_cols=["valor"], unit_col="unidad", scope="laboratorio", section_col="seccion")
    found = differing_units(out.withColumn("tabla", F.lit("t"))).collect()
    assert [(r.id_fila, r.valor_mil) for r in found] == [(1, 100_000)]
    empty = df.where("id < 0")
    assert to_common_unit(empty, ref, id_col="id", name_col="nombre", value_cols=["valor"], unit_col="unidad", scope="laboratorio", section_col="seccion").count() == 0


def test_wide_against_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for fila in range(4000):
        entity = 1 if rnd.random() < 0.4 else rnd.randrange(200)  # a hot entity
        num = rnd.random() if rnd.random() < 0.6 else None
        rows.append((entity, rnd.randrange(5), fila, num, None if num is not None else f"t{fila}", rnd.choice(["a", None])))
    rows += rows[:300]
    schema = "entidad long, columna int, fila long, num double, texto string, unidad string"
    wide = to_wide(spark.createDataFrame(rows, schema).repartition(7), [f"c{i}" for i in range(5)]).collect()
    best = {}
    for e, c, f, n, t, u in rows:
        for kind, v in (("num", n), ("texto", t)):
            if v is not None and f >= best.get((e, c, kind), (-1,))[0]:
                best[e, c, kind] = (f, v, u)
    assert len(wide) == len({r[0] for r in rows})
    for r in wide:
        for i in range(5):
            num, text = best.get((r.entidad, i, "num")), best.get((r.entidad, i, "texto"))
            assert (r[f"c{i}"], r[f"c{i}_fila"], r[f"c{i}_unidad"]) == ((num[1], num[0], num[2]) if num else (None, None, None))
            assert r[f"c{i}_texto"] == (text[1] if text else None)


def test_laboratory_cells(spark, ref):
    rows = [
        (1, 10, "Glucosa", "QUIMICA CLINICA", 90.0, None, "mg/dl"),
        (2, 10, "GLUCEMIA", "Química  clínica", 95.0, None, None),
        (2, 10, "GLUCEMIA", "Química  clínica", 95.0, None, None),
        (3, 10, "Glucosa", "QUIMICA CLINICA", None, "Hemolizado", None),
        (4, 10, "Glucosa", "ORINA", 1.0, None, None),
        (5, None, "Glucosa", "ORINA", 1.0, None, None),
        (6, 11, "Glucosa", None, 1.0, None, None),
    ]
    schema = "id_resultado long, id_estudio int, analito string, seccion string, valor_num double, valor_texto string, unidad string"
    cells = filled_numeric_cells(laboratory_wide(spark.createDataFrame(rows, schema), ref)).collect()
    assert sorted(map(tuple, cells)) == [(10, "GLU", 2), (10, "UGL", 4)]
    none = spark.createDataFrame([], schema)
    assert laboratory_wide(none, ref).count() == 0



"""Parsers, masks, evidence, coverage, funnel, output: literal edges."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cordal.functions import masking, values
from cordal.functions.plausible import plausible_text, stand_in
from cordal.operators import evidence, funnel, leaks, lines, output, parsers
from cordal.plans.pipeline import Pipeline, Registry


def one(spark, column, **cells):
    schema = ", ".join(f"{k} string" for k in cells)
    return spark.createDataFrame([tuple(cells.values())], schema).select(column).first()[0]


def test_numbers_dates_times(spark):
    col = F.col("v")
    assert one(spark, values.normal_number(col), v="12,5") == "12.5"
    assert one(spark, values.normal_number(col), v="-1") is None
    assert one(spark, values.lab_float(col), v="5d") is None
    assert one(spark, values.lab_float(col), v="-1,5") == -1.5
    assert str(one(spark, values.iso_date(col), v="1/2/2020")) == "2020-02-01"
    assert one(spark, values.iso_date(col), v="31/02/2020") is None
    assert one(spark, values.iso_time(col), v="8:45") is None
    assert one(spark, values.time_precision(col), v=None) == "ausente"
    assert one(spark, values.time_precision(col), v="08:45") == "minuto"
    assert tuple(one(spark, values.reference_range(col), v="9 - 32")) == (9.0, 32.0)
    assert tuple(one(spark, values.reference_range(col), v="-1 - 3")) == (None, None)
    assert tuple(one(spark, values.value_and_unit(col), v="36 mm")) == ("36", "mm")
    assert tuple(one(spark, values.value_and_unit(col), v="NORMAL")) == ("NORMAL", None)
    assert one(spark, values.lab_section(col), v="-Ionograma Sérico-") == "IONOGRAMA"
    assert one(spark, values.normal_text(col), v="A|B  Straße") == "a b strasse"


def test_redaction(spark):
    t = F.col("t")
    assert one(spark, masking.redact_ids(t), t="DNI 12.345.678 y 123456, no 12345 ni 1234567890") == "DNI [REDACTADO] y [REDACTADO], no 12345 ni 1234567890"
    names = F.array(F.lit("Pérez, Ana"), F.lit("de"), F.lit(None).cast("string"))
    assert one(spark, masking.redact_names(t, names), t="PEREZ dijo que Ana PÉREZ y Anabel vienen de casa") == "[REDACTADO] dijo que [REDACTADO] [REDACTADO] y Anabel vienen de casa"
    assert one(spark, masking.redact_names(t, F.array().cast("array<string>")), t="x") == "x"
    spans = F.array(*[F.struct(F.lit(a).alias("inicio"), F.lit(b).alias("fin")) for a, b in [(4, 6), (0, 2), (1, 3)]])
    assert one(spark, masking.redact_spans(t, spans), t="abcdefgh") == "[REDACTADO]d[REDACTADO]gh"
    assert one(spark, masking.shape_mask(t), t="Ñandú 12,5 mg") == "X 0,0 X"
    assert one(spark, masking.shape_mask(t, ["mg"]), t="Ñandú 12,5 mg") == "X 0,0 mg"


def test_evidence_codes(spark):
    cases = [("a 12 b", "12", None), ("12 12", "12", "evidencia_ambigua"), ("13", "12", "valor_discrepante"), ("sin", "12", "evidencia_ausente"), (None, "1", "evidencia_ausente")]
    df = spark.createDataFrame(cases, "p string, v string, e string")
    assert all(r[0] == r[1] for r in df.select("e", evidence.evidence_code(F.col("p"), F.col("v"))).collect())


def test_coverage_precedence(spark):
    inv = spark.createDataFrame([(1, 0, 1), (2, 0, 1), (2, 0, 1), (3, 0, 1), (5, 0, 1)], "d int, o int, p int")
    ref = spark.createDataFrame([(1, 0, 1), (2, 0, 1), (3, 0, 2), (4, 0, 1)], "d int, o int, p int")
    got = {r.d: r.codigo for r in evidence.coverage(inv, ref, ["d", "o"], "p").collect()}
    assert got == {1: None, 2: "cobertura_ambigua", 3: "cobertura_incompleta", 4: "cobertura_incompleta", 5: "campo_no_extraido"}


def test_estimate_states(spark):
    cases = [(1000, 199, 5, "midiendo"), (0, 300, 5, "midiendo"), (100, 300, 5, "descuadre"), (300, 300, 0, "disponible"), (400, 300, 0, "sin_avance"), (400, 300, 9, "disponible")]
    df = spark.createDataFrame(cases, "e long, f long, r long, s string")
    got = df.select("s", funnel.estimate(F.col("e"), F.col("f"), F.col("r"), F.lit(600)).alias("x")).collect()
    assert all(r.s == r.x.situacion for r in got)
    assert (got[3].x.minimo_s, got[3].x.maximo_s) == (0.0, 0.0) and got[5].x.minimo_s <= got[5].x.maximo_s


def test_funnel_residue_is_signed(spark):
    rows = lambda n: spark.range(n)
    r = funnel.totals(rows(3), rows(2), rows(4)).first()
    assert (r.residuo, r.cierra) == (-3, False)


def test_leaks_case_folding_and_multiplicity(spark):
    recs = spark.createDataFrame([(1, "STRASSE ab"), (2, "x"), (3, None), (4, "")], "id int, t string")
    lits = spark.createDataFrame([("straße",), ("AB",), ("ab",), ("zz",), (None,)], "l string")
    assert {r.id: r.coincidencias for r in leaks.count_leaks(recs, "id", "t", lits, "l").collect()} == {1: 3}
    with_empty = lits.union(spark.createDataFrame([("",)], "l string"))
    assert {r.id: r.coincidencias for r in leaks.count_leaks(recs, "id", "t", with_empty, "l", block=2).collect()} == {1: 4, 2: 1, 4: 1}


def test_echo_wide_last_label_wins(spark):
    rows = [(1, "AO", "30", "mm", 1), (1, " ao ", "31", "cm", 2), (1, "VD", "NORMAL", None, 3), (2, None, "1", "mm", 4)]
    out = output.echo_wide(spark.createDataFrame(rows, "d int, n string, v string, u string, o int"), "d", "n", "v", "u", "o").collect()
    assert [(r.d, r.ao, r.ai, r.unidades, r.adicionales) for r in out] == [(1, "31", None, {"ao": "cm"}, {"VD": "NORMAL"})]


def test_append_is_idempotent(spark):
    new = spark.createDataFrame([("k", 1), ("k", 2), (None, 3), (None, 4)], "key string, n int")
    once = output.append_new(new, new.limit(0), "key", ["n"])
    assert sorted(r.n for r in once.collect()) == [1, 3, 4]
    assert sorted(r.n for r in output.append_new(new, once, "key", ["n"]).collect()) == [3, 4]


def test_export_publishes_at_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "secreto"), (2, "y", "secreto")], "a int, b string, dni string")
    allowed, folder = {"t": ["a", "b"]}, str(tmp_path)
    with pytest.raises(FileNotFoundError):
        output.exported(spark, folder)
    first = output.export({"t": df}, allowed, folder, {"version": 1}, rows_per_file=1)
    assert output.exported(spark, folder)["t"].columns == ["a", "b"] and first["tablas"]["t"]["filas"] == 2
    part = tmp_path / first["carpeta"] / "t"
    assert {f: hashlib.sha256((part / f).read_bytes()).hexdigest() for f in first["tablas"]["t"]["archivos"]} == first["tablas"]["t"]["archivos"]

    failing = df.withColumn("b", F.raise_error(F.lit("writer fails")).cast("string"))
    with pytest.raises(Exception, match="writer fails"):
        output.export({"u": df, "t": failing}, {"u": ["a"], **allowed}, folder, {"version": 2})
    assert output.exported(spark, folder)["t"].count() == 2  # the run before is still whole

    for version in (3, 4, 5):
        last = output.export({"t": df.limit(1)}, allowed, folder, {"version": version})
    assert output.exported(spark, folder)["t"].count() == 1 and not (tmp_path / first["carpeta"]).exists()
    assert sum(p.name.startswith("run-") for p in tmp_path.iterdir()) == 2 and last["version"] == 5
    with pytest.raises(ValueError):
        output.export({"t": df}, {"x": ["a"]}, folder, {})


LAB = [
    "-HEMATOLOGIA-\nPRUEBA   RESULTADO   UNIDADES\nHematocrito   41,2   %   36 - 48\nRecuento (valor   5200   /mm3   4000 - 10000\n"
    "absoluto) total\nFORMULA LEUCOCITARIA\nNeutrofilos   55   %\nObservacion  POSITIVO\nQUÍMICA CLÍNICA\nUrea | 34 | mg/dl | 10 - 50",
    "IONOGRAMA SERICO\nSodio   140   mmol/L   135 - 145",
]


def test_laboratory_parser(spark):
    out = parsers.parse_laboratory(spark.createDataFrame([(1, LAB)], "id int, p array<string>"), "id", "p").orderBy("ordinal").collect()
    got = [(r.seccion, r.prueba, r.resultado, r.unidades, r.valores_referencia) for r in out]
    assert got == [
        ("HEMATOLOGIA", "Hematocrito", "41,2", "%", "36 - 48"),
        ("HEMATOLOGIA", "Recuento (valor absoluto) total", "5200", "/mm3", "4000 - 10000"),
        ("FORMULA LEUCOCITARIA", "Neutrofilos", "55", "%", None),
        ("FORMULA LEUCOCITARIA", "Observacion", "POSITIVO", None, None),
        ("QUIMICA CLINICA", "Urea", "34", "mg/dl", "10 - 50"),
        ("IONOGRAMA", "Sodio", "140", "mmol/L", "135 - 145"),
    ]


def test_laboratory_header(spark):
    page = "Apellido y Nombre: PEREZ, ANA   X\nFecha: 12/01/2022\nNº Petición: 77\nHora de Extracción: 8:03"
    df = spark.createDataFrame([(1, [page, "Nº Petición: 78"]), (2, [page]), (3, ["nada"])], "id int, p array<string>")
    got = {r.id: r.detalle for r in parsers.laboratory_header(df, "id", "p").collect()}
    assert got == {1: "numero_peticion_inconsistente", 2: "hora_ilegible", 3: "header_ausente"}


ECHO = """SERVICIO DE ECOCARDIOGRAFIA
MEDIDAS VALOR VALOR NORMAL
AO   36 mm   < 41 mm   DDVI   81 mm
FA | 33 | %
VALVULAS CARDIACAS
AORTICA
Trivalva.
CONCLUSIONES
Normal en
reposo.
ANA MARIA PEREZ
Matrícula N 2736"""


def test_echo_parser(spark):
    lines_ = parsers.echo_lines(spark.createDataFrame([(1, [ECHO])], "id int, p array<string>"), "id", "p")
    measures = [(r.nombre, r.valor, r.unidad) for r in parsers.parse_echo_measures(lines_, "id").orderBy("ordinal").collect()]
    assert measures == [("AO", "36", "mm"), ("DDVI", "81", "mm"), ("FA", "33", "%")]
    sections = {r.seccion: r.texto for r in parsers.parse_echo_sections(lines_, "id").collect()}
    assert sections == {"VALVULAS CARDIACAS - AORTICA": "Trivalva.", "CONCLUSIONES": "Normal en reposo."}
    assert tuple(parsers.parse_echo_signature(lines_, "id").first()) == (1, "ANA MARIA PEREZ", "N 2736")


def test_ecg_parser(spark):
    text = "PEREZ~,  ID:55  01-FEB-2022  10:11:12   Hospital X\n03-MAR-1950 (71 yr) Female\n49\nVent. rate\nPR interval 160 ms\nQT/QTc\n708/225\n88\n64\n29\nP-R-T axes"
    r = parsers.parse_ecg(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").first()
    assert (r.vent_rate, r.pr_interval, r.qrs_duration, r.qt_qtc, r.ejes) == ("49", "160 ms", None, "708/225", "88 64 29")
    assert (str(r.fecha_estudio), r.hora_estudio, r.fecha_nac, r.codigo) == ("2022-02-01", "10:11:12", "1950-03-03", None)


def test_axes_need_two(spark):
    df = spark.createDataFrame([(["x", "1", "P-R-T", "2", "3"],)], "l array<string>")
    assert df.select(lines.axes_near_label(F.col("l"), F.lit(2))).first()[0] is None


def test_plausible_text_is_stable():
    text = "Ana Pérez 12/01/2022 08:05 HEMATOLOGIA 41,2"
    out = plausible_text(text, frozenset(["HEMATOLOGIA"]), "s")
    assert out == plausible_text(text, frozenset(["HEMATOLOGIA"]), "s") and "HEMATOLOGIA" in out and "Pérez" not in out
    assert len(stand_in("1234", "s")) == 4 and stand_in("0", "s").isdigit()


def test_pipeline_is_total(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "n int")
    fail = lambda k, code: lambda d: d.withColumn("codigo", F.when(F.col("n") % k == 0, code))
    ok, bad = Pipeline().add("uno", fail(3, "x")).add("dos", fail(2, "y")).run(df)
    assert ok.count() + bad.count() == 10
    assert {r.n: (r.codigo, r.etapa) for r in bad.collect()}[6] == ("x", "uno")
    try:
        Registry(a=lambda d: d)["b"]
        raise AssertionError("an unknown kind must fail")
    except KeyError:
        pass

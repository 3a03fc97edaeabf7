"""Queries over all rows of their tables, against brute force on small fixtures."""

import re
from datetime import date

import pytest

from cordal.operators import identity
from cordal.plans import linking, parsing, staged, texts


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def blanks(text):
    return None if text is None else re.sub(r"\s+", " ", text).strip()


ECG = [
    ("117", "156", "119", "442/465", "41 117 8"), ("136 lpm", "155 ms", None, "QT=336\nQTc=394", "33\n89\n94"),
    (None, None, "90", "484/---", None), ("52 BPM", None, None, None, '"7","19","9"'),
    ("60", "150", "80", "357\t439", "P=46, QRS=74, T=38"), (None, "140", None, " 358 - 376 ms ", "P:31|R:88|T:24"), ("50", None, "81", "462/377", "59"), ("51", "---", "82", "1/2", "---"), (None, None, None, None, None),
]


def test_ecg_pages_keep_every_study_and_measure(spark, tmp_path):
    rows = [(i, *r) for i, r in enumerate(ECG)]
    write(spark, tmp_path, "medicion_ecg", rows + rows[:2], "id_estudio int, vent_rate string, pr_interval string, qrs_duration string, qt_qtc string, ejes string")
    out = parsing.parse_ecg_pages(spark, str(tmp_path)).collect()
    got = {r.id_estudio: (r.vent_rate, r.pr_interval, r.qrs_duration, r.qt_qtc, r.ejes) for r in out}
    assert len(out) == len(ECG) and all(r.codigo is None and r.fecha == "2020-01-02" for r in out)
    assert all(r.anclado == (r.vent_rate is not None) and r.cruzado is (r.vent_rate == r.pr_interval is not None) for r in out)
    assert got == {r[0]: tuple(blanks(v) if v and re.search(r"\d", v) else None for v in r[1:]) for r in rows}


SECTIONS = {
    "HEMATOLOGÍA ": "HEMATOLOGIA", "Orina completa": "ORINA COMPLETA", "Quimica  clinica": "QUIMICA CLINICA", "-QUÍMICA CLÍNICA-": "QUIMICA CLINICA",
    "Ionograma Sérico": "IONOGRAMA", "ORINA": "ORINA", "-ORINA-": "ORINA", "ORINA  COMPLETA": "ORINA COMPLETA", "-HEMATOLOGIA-": "HEMATOLOGIA",
    "HEMOSTASIA Y COAGULACION": "HEMOSTASIA Y COAGULACION", "Hemostasia": "HEMOSTASIA", "IONOGRAMA": "IONOGRAMA",
}


@pytest.fixture
def laboratory(spark, tmp_path):
    titles = list(SECTIONS)
    rows = []
    for study in range(len(titles)):  # each title is the first of a study once
        for k, title in enumerate(titles[study:] + titles[:study]):
            rows.append((100 * study + k, study, title, [" Urea ", "Sodio", "a|b"][k % 3], ["41,2", "POSITIVO", "5\nx"][k % 3], [None, " mg / dl", "%", ""][k % 4]))
    write(spark, tmp_path, "laboratorio_crudo", rows + rows[:3], "id_fila long, id_estudio int, seccion string, prueba string, resultado string, unidades string")
    return str(tmp_path), rows


def test_laboratory_pages_keep_every_row_and_section(spark, laboratory):
    folder, rows = laboratory
    got = sorted(tuple(r) for r in parsing.parse_laboratory_pages(spark, folder).collect())
    cell = lambda x: re.sub(r"[\n|]", " ", x or "").strip()
    assert got == sorted((s, i % 100, SECTIONS[t], cell(p), cell(r), cell(u) or None) for i, s, t, p, r, u in rows)


def test_laboratory_inventory_covers_every_row(spark, laboratory):
    folder, rows = laboratory
    out = parsing.reconcile_laboratory_pages(spark, folder).collect()
    assert len(out) == len(rows) and all((r.n_inv, r.n_ref, r.codigo) == ((1, 0, "campo_no_extraido") if r.ordinal % 7 == 3 else (1, 1, None)) for r in out)


TEXTS = [
    "A|B  Straße", "Mba'ẽ\u00a0\u2003 ≥ 5", "“Paz” • x\u200by \ufffd", "√┤ ПАЗ", "ΟΔΟΣ  fin", "a\u0085b", "ﬁn\u2028 İ ŉ", "ÁRBOL Ñ\tµ", "ẞ ſ",
    "Edad: 50 a\u0085b\u2028c\nx", "Petición: Nº 7\u20298  resto", None,
]


def test_normal_text_of_every_document(spark, tmp_path):
    write(spark, tmp_path, "documents", list(enumerate(TEXTS)), "doc_id long, text string")
    out = texts.normal_text(spark, str(tmp_path)).collect()
    got = {r.doc_id: r.normal for r in out}
    assert {r.doc_id: r.primer_segmento for r in out} == {i: re.split(r"\s{2,}", t.strip(" "))[0].strip(" ") for i, t in enumerate(TEXTS) if t is not None}
    fold = lambda t: "µ".join(p.casefold() for p in t.split("µ"))
    assert got == {i: re.sub(r"\s+", " ", fold(t.replace("|", " "))).strip() for i, t in enumerate(TEXTS) if t is not None}


def test_header_fields_of_every_document(spark, tmp_path):
    write(spark, tmp_path, "documents", list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: (r.peticion, r.edad) for r in texts.header_fields(spark, str(tmp_path)).collect()}
    assert len(got) == len(TEXTS) - 1
    assert (got[9], got[10]) == ((None, "50 a\u0085b\u2028c"), ("7\u20298", None))


D = date(2024, 1, 1)
STUDIES = [
    (1, "a", "x", "laboratorio", D), (2, None, "x", "ecg", D), (3, None, "x", "ecocardiograma", D),  # one episode through the bridge
    (4, "b", "y", "laboratorio", D), (5, "c", "y", "laboratorio", D), (6, None, "y", "ecg", D),  # two patients claim y
    (7, None, "z", "ecg", D), (8, None, None, "ecg", D), (9, None, "x", "ecg", None), (10, "d", None, "ecg", D), (11, "d", None, "ecg", D),
]
CODES = {
    "aprobado": 3, "episodio_incompleto": 2, "clave_pii_ambigua": 1, "clave_pii_no_resuelta": 2, "parseo_incompleto": 1, "episodio_ambiguo": 2,
}


@pytest.fixture
def all_studies(spark, tmp_path):
    schema = "id_estudio int, id_paciente string, id_alt_paciente string, tipo_documento string, fecha_estudio date"
    write(spark, tmp_path, "estudio", STUDIES + STUDIES[:2], schema)
    return str(tmp_path)


def test_every_study_has_a_destination(spark, all_studies):
    got = {r.destino: r.documentos for r in linking.gate_destinations(spark, all_studies).collect()}
    assert got == CODES
    assert linking.gate_totality(spark, all_studies).first().sin_destino == 0


def test_totality_sees_a_lost_study(spark, all_studies, monkeypatch):
    whole = identity.resolve
    monkeypatch.setattr(identity, "resolve", lambda *a: whole(*a).where("resuelto IS NOT NULL"))
    assert linking.gate_totality(spark, all_studies).first().sin_destino == 3


SECTIONS_ECO = [
    "Paz refiere DNI 12.345.678, mail ana.1@x.com y ana.1@x.com; Guadalupe y PAZ", "Eco a@b.co xa@b.co a@b.co 1234567 Silvia  Federte",
    "Nota ana1234567@x.com guadalupe.p@casa-1.org", "Normal", "Solo 40123456",
]


def test_all_redaction_layers_run(spark, tmp_path):
    write(spark, tmp_path, "texto_seccion_eco", list(enumerate(SECTIONS_ECO)) + [(9, None)], "id_seccion long, texto string")
    names = {0: "Páz, Guadalupe", 1: "Silvia Federte", 2: None}
    ids = {k: next(c for c in "abcdefghijklmnopqrstuvwxyz0123456789" if (ord(c) * 7 + len(n)) % 64 == k) if n and any((ord(c) * 7 + len(n)) % 64 == k for c in "abcdefghijklmnopqrstuvwxyz0123456789") else None for k, n in names.items()}
    rows = [(i, names[k]) for k, i in ids.items() if i] + [("x", None)]
    write(spark, tmp_path, "firma_medico", rows, "id_medico string, nombre string")
    slots = {(ord(i) * 7 + len(n)) % 64: n for i, n in rows if n}
    got = {r.id_seccion: r.texto_redactado for r in texts.redact_layers(spark, str(tmp_path)).collect()}
    mark, want = "[REDACTADO]", {}
    folds = {"á": "a", "í": "i"}
    for i, t in enumerate(SECTIONS_ECO):
        name = slots.get(i)
        t += f" Informado por {name}." if name else ""
        t = re.sub(r"(?<![\d.])\d{1,2}\.\d{3}\.\d{3}(?!\d)|(?<!\d)\d{6,8}(?!\d)", mark, t)
        if name:
            clean = re.sub(r"[\s,]+", " ", name)
            parts = sorted({clean, *clean.split()}, key=len, reverse=True)
            body = "|".join("".join("[aá]" if folds.get(c, c) == "a" else r"\s+" if c == " " else re.escape(c) for c in p.lower()) for p in parts)
            t = re.sub(rf"(?i)(?<!\w)(?:{body})(?!\w)", mark, t)
        want[i] = re.sub(r"(?:[\w.+-]|\[REDACTADO\])+@(?:[\w.-]|\[REDACTADO\])+", mark, t)
    assert got == want and len(slots) > 0
    assert not any("@" in t or "1234567" in t for t in got.values())


def test_pipeline_over_all_studies(spark, all_studies, tmp_path):
    sections = [(7, 3, "DNI 12345678, a@b.co"), (5, 3, "Normal"), (5, 3, "Normal"), (8, 3, None), (6, 7, "en cuarentena 12345678")]
    write(spark, tmp_path, "texto_seccion_eco", sections, "id_seccion long, id_estudio int, texto string")
    totals = staged.pipeline_totals(spark, all_studies).first().asDict()
    assert totals == {"entrada": 11, "publicados": 3, "en_cuarentena": 8, "diferencia": 0, "secciones": 2, "redacciones": 2}
    out = {r.id_estudio: r for r in staged.pipeline_published(spark, all_studies).collect()}
    assert set(out) == {1, 2, 3} and len({r.clave_paciente for r in out.values()}) == len({r.clave_episodio for r in out.values()}) == 1
    assert out[3].textos == "5:Normal\n7:DNI [REDACTADO], [REDACTADO]" and "resuelto" not in out[1]
    bad = staged.staged(spark, all_studies).run(linking.studies(spark, all_studies))[1].groupBy("etapa").count()
    assert {r.etapa: r["count"] for r in bad.collect()} == {"identidad": 3, "fecha": 1, "episodio": 4}

"""Personal data, leaked items, garbled text: literal edges, round trips, brute force."""

import hashlib
import random

import pytest

from cordal.llm.leakage import Scanner, best_stretches, leaked_items, words
from cordal.llm.mojibake import PAIRS, garbled, label, restore
from cordal.llm.personal_data import date_pseudonym, find, protect, protected_texts, pseudonym, unfeistel

KEY = b"k"


def spans(text):
    return {(text[a:b], k) for a, b, k in find(text)}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Retira FULONCO Mariela con documento 9.876.543.", {("FULONCO Mariela", "PERSON"), ("9.876.543", "ID_NUMBER")}),
        ("Se avisa a la Dra. Grabruzzi, Claudia el resultado.", {("Grabruzzi, Claudia", "PERSON")}),
        ("firma: Guillermo Dulappo Se aplicó la regla de Corvelo.", {("Guillermo Dulappo", "PERSON")}),
        ("Contacto: +54 9 998 437 6400 (M. Fadubrún).", {("+54 9 998 437 6400", "PHONE_NUMBER"), ("M. Fadubrún", "PERSON")}),
        ("avisar al 0998/456-3628 int. 129.", {("0998/456-3628 int. 129", "PHONE_NUMBER")}),
        ("Remitir a raul[at]casilla.invalid.", {("raul[at]casilla.invalid", "EMAIL_ADDRESS")}),
        ("mail (t.p+x arroba red punto garza punto example)", {("t.p+x arroba red punto garza punto example", "EMAIL_ADDRESS")}),
        ("vive en Sauce Llorón 3581 piso 7 depto B. ZEGOJARA Paula espera", {("Sauce Llorón 3581 piso 7 depto B", "STREET_ADDRESS"), ("ZEGOJARA Paula", "PERSON")}),
        ("Domicilio declarado: B° Puerto Arena Mz 34 Casa 7.", {("B° Puerto Arena Mz 34 Casa 7", "STREET_ADDRESS")}),
        ("en la casa de José Paz, LAS GARZAS 12 Flujo", {("José Paz", "PERSON"), ("LAS GARZAS 12", "STREET_ADDRESS")}),
        ("Según cuenta martín trugirza, ayer.", {("martín trugirza", "PERSON")}),
        ("cuil 27-61845955-0 figura", {("27-61845955-0", "ID_NUMBER")}),
        ("Comparado con estudio N° 76-546518. Reactivo lote 77.784.607 vigente. Escala Timbó 12-9876543.", set()),
        ("signo de Varlenga ausente, Hospital Zonal del Ceibo, Policlínico Tres Esteros. Llamar 0800-1450.", set()),
        ("", set()),
    ],
)
def test_find(text, expected):
    assert spans(text) == expected


def test_pseudonyms_keep_format_and_link():
    a, b = pseudonym("82.615.686", "ID_NUMBER", KEY), pseudonym("82615686", "ID_NUMBER", KEY)
    assert a.replace(".", "") == b and [len(p) for p in a.split(".")] == [2, 3, 3] and b != "82615686"
    tax = pseudonym("27-82615686-0", "ID_NUMBER", KEY)
    assert tax[3:11] == b  # the inner number of a tax number stays linked
    phone = pseudonym("0998/456-3628 int. 12", "PHONE_NUMBER", KEY)
    assert phone.startswith("0998/") and phone.endswith(" int. 12")
    rnd = random.Random(3)
    for n in (2, 3, 5, 8):
        seen = {pseudonym(str(i).zfill(n), "x", KEY) for i in range(min(10**n, 400))}
        assert len(seen) == min(10**n, 400)  # a permutation never collides
        text = "".join(rnd.choice("0123456789") for _ in range(n))
        assert unfeistel(pseudonym(text, "x", KEY), KEY, "x") == text
    moved = date_pseudonym("05/03/2020", KEY)
    assert moved != "05/03/2020" and len(moved) == 10 and date_pseudonym("31/02/2020", KEY) == "31/02/2020"


def test_protected_texts(spark):
    long = "sin datos. " * 20_000 + "DNI 82.615.686."
    df = spark.createDataFrame([(1, "Paciente Ana Paz, DNI 82615686."), (2, None), (3, ""), (4, long)], "k long, texto string")
    got = {r.id: r for r in protected_texts(df, "k", "texto", KEY).collect()}
    assert set(got) == {1, 3, 4} and got[3].datos == []
    assert got[1].texto_seguro.startswith("Paciente [PERSON], DNI ") and "82615686" not in got[1].texto_seguro
    assert got[4].datos[0].inicio == len(long) - 11
    assert protect("x", KEY) == ("x", [])


ITEM = " ".join(f"palabra{i}" for i in range(40))


def scan(text, item=ITEM):
    return [(i, round(s, 2)) for i, s, _ in Scanner([(1, item)]).scan(text)]


def test_leaks():
    tokens = ITEM.split()
    assert scan("x " + ITEM.upper().replace(" ", "\n") + " y") == [(1, 1.0)]
    assert scan(" ".join(tokens[:20]) + " relleno " * 30 + "fin") == [(1, 0.5)]
    assert scan(" ".join(tokens[:18])) == []
    assert scan(" ".join(tokens[25:38]) + " otra cosa " * 10 + " ".join(tokens[3:15])) == [(1, round(25 / 40, 2))]
    edited = [w if i % 9 else "cambio" for i, w in enumerate(tokens)]
    assert scan(" ".join(edited))[0][1] > 0.6
    assert scan("hiper-\n tensión arterial leve", "hipertensión arterial leve") == [(1, 1.0)]
    assert scan("") == [] and Scanner([(1, "")]).any is False
    assert scan("dos palabras", "dos palabras") == [(1, 1.0)]


def test_offsets_point_into_the_original():
    text = "Á «" + ITEM + "»"
    (_, _, cut), = Scanner([(1, ITEM)]).scan(text)
    assert text[cut[0] : cut[1]] == ITEM
    assert words("Ñandú, 3º")[0] == ["nandu", "3o"]


def test_stretches_do_not_overlap():
    rnd = random.Random(2)
    for _ in range(50):
        seeds = [(rnd.randrange(60), rnd.randrange(40)) for _ in range(rnd.randrange(1, 60))]
        out = best_stretches(seeds, 3)
        assert 1 <= len(out) <= 2
        if len(out) == 2:
            (_, a, b), (_, c, d) = out
            assert b < c or d < a


def test_leaked_items_in_blocks(spark):
    docs = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, "nada"), (4, "abc " + ITEM)], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "otra frase que no aparece"), (10, "")], "item_id long, texto string")
    for block in (60, 1 << 20):
        got = sorted((r.doc_id, r.item_id) for r in leaked_items(docs, items, block).collect())
        assert got == [(1, 7), (4, 7)]


CLEAN = [
    "El niño volvió al médico: presión 12 ½, área 3 cm², 37 °C ± 1. ¿Síncope? No. Válvula aórtica, corazón.",
    "AVALIAÇÃO da função: não há lesões; CONCLUSÃO: manhã, coração. MANHÃ:",
    "Pohãno hasýva haguã mokõi ñe'ẽme pytyvõ mitã",
    "RELATÓRIO MÉDICO: ECOGRAFÍA CARDÍACA, Índice 2,5 µg/mL «normal»",
    "plain ASCII text? yes",
    "",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_stays(text):
    assert label(text) == [] and restore(text) is None


@pytest.mark.parametrize("pair", range(len(PAIRS)))
def test_round_trip(pair):
    true, wrong, times = PAIRS[pair]
    checked = 0
    for text in CLEAN[:1] + CLEAN[3:4]:
        bad = text
        try:
            for _ in range(times):
                bad = "".join(c for c in bad)
                raw = bad.encode(true)
                bad = "".join(bytes([b]).decode(wrong) if _known(b, wrong) else chr(b) for b in raw)
        except UnicodeEncodeError:
            continue
        if bad == text:
            continue
        found = restore(bad)
        assert found is not None and not found[1]
        assert found[2] == text, (PAIRS[pair], bad)
        checked += 1
    assert checked or true in ("cp437", "mac_roman", "cp850")


def _known(byte, encoding):
    try:
        bytes([byte]).decode(encoding)
        return True
    except UnicodeDecodeError:
        return False


def test_garbled_stretch_and_losses(spark):
    whole = "La fibrilación auricular del niño. "
    bad = whole.encode().decode("cp1252")
    rows = [
        (1, whole * 3 + bad + whole), (2, "geometr�a"), (3, "internaci?n leve"), (4, "lÃmite y crÃtico"),
        (5, whole), (6, None), (7, ""), (8, whole * 3000 + bad),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in garbled(df.union(df)).collect()}
    assert set(got) == {1, 2, 3, 4, 8}
    assert got[1].md5_texto == hashlib.md5((whole * 5).encode()).hexdigest()
    assert got[8].restaurado == whole * 3001
    assert [got[i].md5_texto for i in (2, 3, 4)] == ["", "", ""]


def test_answers_are_reported_behind_their_question_only():
    items = [(1, ITEM, "digital oral"), (2, "otra pregunta sobre el ritmo nodal acelerado", "B")]
    text = "digital oral. " + ITEM + " Respuesta: Digital  oral."
    (item, _, cut), = Scanner(items).scan(text)
    assert item == 1 and text[cut[4] : cut[5]] == "Digital  oral"
    text = "b a la Otra pregunta sobre el ritmo nodal acelerado, va b o no: B"
    (item, _, cut), = Scanner(items).scan(text)
    assert item == 2 and text[cut[4] : cut[5]] == "B" and cut[4] == len(text) - 1
    assert list(Scanner(items).scan("digital oral, B")) == []  # an answer alone is no leak
    assert list(Scanner([(3, ITEM, None)]).scan(ITEM))[0][2][4:] == [None, None]

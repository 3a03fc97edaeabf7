"""Names are found by structure: given names that no list holds, over the echo texts and in plain cases."""

import random
import re
from pathlib import Path

import duckdb
import pytest

from cordal.llm.lexicon import bare
from cordal.llm.personal_data import _GIVEN, find

UNLISTED = (
    "Aldana Thiago Kevin Germán Milagros Brenda Jonathan Nahuel Lautaro Micaela Rodrigo Yamila Evelyn Ramiro Abril Dylan"
    " Ailén Leonel Gisela Bruno Jazmín Uriel Melina Franco Priscila Nazareno"
).split()
TEXTS = Path("/root/testdata/sf0.01/texto_seccion_eco.parquet")


def people(text):
    return [text[a:b] for a, b, k in find(text) if k == "PERSON"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Firma: Dr. Thiago Villalba", ["Thiago Villalba"]),
        ("Paciente: Kevin Duarte", ["Kevin Duarte"]),
        ("Se informa al Dr. Villalba.", ["Villalba"]),
        ("Aldana R. Benítez refiere dolor.", ["Aldana R. Benítez"]),
        ("Retira DUARTE Kevin con documento 28.765.432.", ["DUARTE Kevin"]),
        ("a nombre de PEÑA LARRE, MILAGROS Ventana acústica", ["PEÑA LARRE, MILAGROS"]),
        ("avisar a la Sra. melina ortuzar.", ["melina ortuzar"]),
        ("Motilidad conservada. Válvula Mitral normal. Aorta, Mitral y Tricúspide sin cambios.", []),
        ("Hospital Ramiro Ledesma, Clínica Del Parque. Escala Timbó 12. Signo de Varlenga Corva ausente.", []),
        ("VALVULAS CARDIACAS\nAORTICA normal. FLUJO MITRAL laminar.", []),
        ("", []),
    ],
)
def test_structure(text, expected):
    assert people(text) == expected


def replaced(text, spans, rnd):
    """The text with every listed given name inside a person's span made an unlisted one, and its spans."""

    def other(m):
        if bare(m[0]) not in _GIVEN:
            return m[0]
        new = rnd.choice(UNLISTED)
        return new.upper() if m[0].isupper() else new.lower() if m[0].islower() else new

    out, end, moved = "", 0, []
    for a, b, kind in spans:
        out += text[end:a]
        new = re.sub(r"[^\W\d_]+", other, text[a:b]) if kind == "PERSON" else text[a:b]
        moved.append((len(out), len(out) + len(new), kind, new != text[a:b]))
        out, end = out + new, b
    return out + text[end:], moved


@pytest.mark.skipif(not TEXTS.exists(), reason="test tables are not here")
def test_recall_without_the_list():
    rnd = random.Random(5)
    texts = duckdb.sql(f"SELECT DISTINCT texto FROM '{TEXTS}' WHERE texto IS NOT NULL ORDER BY 1").fetchall()
    asked = found = false = 0
    for (text,) in texts:
        new, spans = replaced(text, find(text), rnd)
        if any(s[3] for s in spans):
            got = set(find(new))
            asked += sum(s[3] for s in spans)
            found += sum(s[3] and s[:3] in got for s in spans)
            false += len(got - {s[:3] for s in spans})
    assert asked > 150 and found / asked >= 0.9 and false / asked <= 0.01

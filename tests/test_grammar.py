"""Printed labels as patterns."""

import re

import pytest

from cordal.functions.grammar import NUMBER, behind, label, only, optional


@pytest.mark.parametrize(
    ("text", "line", "value"),
    [
        ("Médico( derivante):", "Medico derivante:  Ana Paz", "Ana Paz"),
        ("Médico( derivante):", "Médico: Ana Paz", "Ana Paz"),
        ("Nº Petición:", "N°Peticion: 12", "12"),
        ("Hora( de) Extracción:", "Hora Extracción: 08:30", "08:30"),
        ("F.Nacimiento:?", "F.Nacimiento : 01/02/1980", "01/02/1980"),
        ("S.C.:?", "S.C. 1,9", "1,9"),
    ],
)
def test_behind(text, line, value):
    assert re.search(behind(text), line)[1] == value


def test_label_keeps_marks_literal():
    assert not re.search(label("F.Nacimiento"), "FxNacimiento") and not re.search(label("Médico:"), "Médicos:")


@pytest.mark.parametrize(("text", "fits"), [("12", True), ("-3,5", True), ("120/80", True), ("12 mm", False), ("1.2.3", False), ("", False)])
def test_numbers(text, fits):
    assert bool(re.search(only(NUMBER, optional("/" + NUMBER)), text)) == fits

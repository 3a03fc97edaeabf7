"""Dates of protected texts; losses in pure ASCII."""

from cordal.llm.mojibake import garbled, restore
from cordal.llm.personal_data import date_pseudonym, find, protect

KEY = b"clave de prueba"


def test_dates_outside_the_spans_are_moved():
    text = "Nacida 05/03/1960, DNI 12.345.678, control 1-2-2024 y 31/02/2020; mail ana@x.com el 05/03/1960."
    safe, data = protect(text, KEY)
    moved = date_pseudonym("05/03/1960", KEY)
    assert moved != "05/03/1960" and safe.count(moved) == 2 and date_pseudonym("1-2-2024", KEY) in safe
    assert "05/03/1960" not in safe and "1-2-2024" not in safe and "31/02/2020" in safe
    assert [d[:3] for d in data] == find(text) and "DATE" not in {d[2] for d in data}


def test_losses_in_ascii_are_reported(spark):
    rows = [(1, "Ficha N? 12"), (2, "dijo ?Cual es"), (3, "plain text? Yes"), (4, "se?al"), (5, "N?12"), (6, "nada")]
    got = {r.doc_id: r.md5_texto for r in garbled(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: "" for i, t in rows if restore(t)} == {1: "", 2: "", 4: "", 5: ""}

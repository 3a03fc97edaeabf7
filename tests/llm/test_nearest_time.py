"""Nearest-time pairing against brute force, with ties, nulls and a hot entity."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cordal.llm.nearest_time import ecg_with_laboratory, instant, nearest_in_time, second_of_day

SCHEMA = "entidad string, id int, t long"


def brute(left, right, tolerance):
    out = set()
    for e, i, t in set(left):
        near = [(abs(t - u), u, j) for f, j, u in right if e is not None and e == f and None not in (t, u) and abs(t - u) <= tolerance]
        if near:
            out.add((i, min(near)[2], min(near)[0]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    row = lambda i: (None if rnd.random() < 0.05 else rnd.choice("aaab"), i, None if rnd.random() < 0.05 else rnd.randrange(0, 400))
    left, right = [row(i) for i in range(150)], [row(i) for i in range(150)]
    right += right[:20]
    got = nearest_in_time(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), tolerance=7, slot=16)
    assert {tuple(r) for r in got.collect()} == brute(left, right, 7)


def test_ties_and_bounds(spark):
    left = [("a", 1, 100), ("a", 2, 205)]
    right = [("a", 12, 90), ("a", 11, 90), ("a", 13, 110), ("a", 14, 210), ("a", 15, 200)]
    got = nearest_in_time(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), tolerance=10, slot=1000)
    assert {tuple(r) for r in got.collect()} == {(1, 11, 10), (2, 15, 5)}
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest_in_time(empty, empty).count() == 0
    with pytest.raises(ValueError):
        nearest_in_time(empty, empty, tolerance=10, slot=5)


def test_typed_hours(spark):
    cases = {
        "8:05": 29100, "08.05": 29100, "08h05": 29100, " 08:05": 29100, "08:05 hs": 29100, "08:05:09": 29109, "01:05 p.m.": 47100,
        "12:30 a.m.": 1800, "12:30 p.m.": 45000, "24:00": None, "8:60": None, "": None, "ausente": None,
    }
    df = spark.createDataFrame(list(cases.items()), "h string, s int")
    assert all(r[0] == r[1] for r in df.select("s", second_of_day(F.col("h"))).collect())
    assert df.select(instant(F.lit(date(1970, 1, 2)), F.lit("00:01")).alias("x")).first().x == 86460


def test_whole_tables_with_extra_columns(spark):
    ecg = spark.createDataFrame([(1, "p", date(2024, 1, 1), "23:50", "x"), (2, None, date(2024, 1, 1), "10:00", "x")], "id_estudio int, id_paciente string, fecha_estudio date, hora_estudio string, franja string")
    lab = spark.createDataFrame([(7, "p", date(2024, 1, 2), "00:30", "laboratorio"), (8, "p", date(2024, 1, 1), "23:49", "ecg")], "id_estudio int, id_paciente string, fecha_estudio date, hora_estudio string, tipo_documento string")
    assert [tuple(r) for r in ecg_with_laboratory(ecg, lab).collect()] == [(1, 7, 2400)]

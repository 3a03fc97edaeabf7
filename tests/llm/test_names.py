"""Spelling variants: parsing, pair rules, whole resolution."""

import random

from cordal.llm.names import components, distance_one, linked_pairs, match_score, parse_name, same_person, stated_specialty

SCHEMA = "id string, nombre string, matricula string, especialidad string, institucion string, persona string"


def classes(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return {r.id: r.persona for r in same_person(df).collect()}


def test_parse():
    p = parse_name("Prof. Dra. MercedesPecoguía Cunelver")
    assert p["givens"] == ["mercedes"] and p["first"] == ["pecoguia"] and p["second"] == ["cunelver"]
    assert parse_name("SURASKA VEVENCO, IGNACIO RAFAEL")["middles"] == ["rafael"]
    assert parse_name("Dopeñón R.")["initials"] == ["r"] and parse_name("Dopeñón R.")["first"] == ["dopenon"]
    assert parse_name("G0NZALO TOCUVÉS PUBURZA")["givens"] == ["gonzalo"]
    assert parse_name("D.F. Ledoska F.")["middle_initials"] == ["f"]
    assert parse_name("Fco. Nigorabal")["givens"] == ["francisco"]
    assert parse_name("Facunfo Pagiguía")["givens"] == ["facundo"]
    assert parse_name("Dra. E Grazondo")["initials"] == ["e"]
    assert all(v == [] for v in parse_name(None).values()) and all(v == [] for v in parse_name("  ").values())
    assert stated_specialty("Ana Paz (Hematología)") == "hematología" and stated_specialty("Ana Paz // jefe de servicio") is None


def test_distance_one_against_brute_force():
    def near(a, b):
        edits = {a}
        for i in range(len(a) + 1):
            edits |= {a[:i] + c + a[i:] for c in "ab"} | {a[:i] + a[i + 1 :]} | {a[:i] + c + a[i + 1 :] for c in "ab" if i < len(a)}
            if i + 1 < len(a):
                edits.add(a[:i] + a[i + 1] + a[i] + a[i + 2 :])
        return b in edits

    rnd = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(6))) for _ in "xy")
        assert distance_one(a, b) == near(a, b), (a, b)


def test_variants_meet_and_others_do_not(spark):
    rows = [
        ("a1", "Dr. Gonzalo Tocuvés Puburza", "MP 20433", "Nefrología", "H1"),
        ("a2", "TOCUVÉSPUBURZA GONZALO", "Mat. 20.433", None, "H1"),
        ("a3", "G. Tocuvés P.", None, "Nefrología", "H1"),
        ("a4", "Gonza Tocuves", "20433", None, None),
        ("a5", "Gonzalo Tocuvez Puburza", None, "Nefrología", "H2"),
        ("a6", "Puburza Tocuvés, Gonzalo", "MP 20343", "Nefrología", "H1"),
        ("b1", "DR. Gonzalo Tocuvés Civoska", "21259", "Pediatría", "H3"),
        ("c1", "Graciela Tocuvés Puburza", "23999", "Guardia", "H1"),
        ("d1", None, None, None, None),
        ("d2", "", "20433", None, None),
    ]
    got = classes(spark, rows + rows[:3])
    assert len(got) == len(rows)
    same = {i for i, p in got.items() if p == got["a1"]}
    assert same == {"a1", "a2", "a3", "a4", "a5", "a6"}
    assert len({got[i] for i in ("b1", "c1", "d1", "d2")}) == 4


def test_ambiguous_initial_stays_apart(spark):
    rows = [
        ("a", "Ana Fozondo Vogabal", "1111111", "Guardia", "H1"),
        ("b", "Alicia Fozondo Rolelde", "2222222", "Guardia", "H1"),
        ("s", "A. Fozondo", None, "Guardia", "H1"),
    ]
    assert len(set(classes(spark, rows).values())) == 3


def test_pairs(spark):
    df = spark.createDataFrame([("x", "p"), ("y", "p"), ("z", "p"), ("w", "q")], "id string, persona string")
    assert sorted(map(tuple, linked_pairs(df).collect())) == [("x", "y"), ("x", "z"), ("y", "z")]


def test_empty(spark):
    assert classes(spark, []) == {}


def test_components_against_brute_force(spark):
    rnd = random.Random(4)
    links = [(f"n{rnd.randrange(60):02d}", f"n{rnd.randrange(60):02d}") for _ in range(45)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.pid: r.clase for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {x: find(x) for x in root}


def test_rules_are_symmetric():
    names = ["Ana Paz Rey", "PAZ REY, ANA", "A. Paz", "Ana B. Paz", "Paz A.", "Ana María Paz Gil"]
    full = [{k: set(v) for k, v in parse_name(n).items()} | {"licences": set(), "specialties": {"x"}, "institutions": {"h"}} for n in names]
    for a in full:
        for b in full:
            assert match_score(a, b) == match_score(b, a)

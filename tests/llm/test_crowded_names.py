"""A usual surname: keys that many profiles share are split, and no sure link is lost."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pandas as pd

from cordal.llm import names
from cordal.llm.lexicon import GIVEN_NAMES
from cordal.llm.names import LARGE_KEY, blocking_keys, distance_one, match_score, parse_name, same_person

SCHEMA = "id string, nombre string, matricula string, especialidad string, institucion string"


def people(n, seed):
    """Spellings of ``n`` people called García, and how many of each; licences are apart."""
    rnd, rows = random.Random(seed), []
    syllables = [a + b for a in "bcdfglmnprstvz" for b in "aeiou"]
    for k in range(n):
        given, other = rnd.choice(GIVEN_NAMES), "".join(rnd.choice(syllables) for _ in range(4)).capitalize()
        field, licence = rnd.choice(["Guardia", "Cardiología"]), str(20_000 + 7 * k)
        rows.append((f"{k:05d}a", f"{given} García {other}", licence, field, None))
        rows.append((f"{k:05d}b", f"GARCÍA {other.upper()}, {given.upper()}", None, field, None))
    return rows


def classes(spark, rows, limit):
    found = same_person(spark.createDataFrame(rows, SCHEMA), limit).collect()
    return {r.id: r.persona for r in found}


def test_ten_thousand_people_of_one_surname(spark):
    got = classes(spark, people(10_000, 3), LARGE_KEY)
    assert len(got) == 20_000
    assert all(got[f"{k:05d}a"] == got[f"{k:05d}b"] for k in range(10_000))
    owners = defaultdict(set)
    for spelling, person in got.items():
        owners[person].add(spelling[:5])
    assert sum(len(v) > 1 for v in owners.values()) <= 10  # people whose names are one letter apart


def test_splitting_keys_loses_nothing(spark):
    rows = people(150, 5)
    assert classes(spark, rows, 4) == classes(spark, rows, 10**9)


def crowd():
    """Guards A. García of one key, and sparse spellings that fit one of them each but share nothing else with it."""
    others = [g for g in GIVEN_NAMES if g.startswith("A")]
    rows = people(40, 7) + [(f"x{k:02d}", f"{g} García {o}", str(70_000 + 7 * k), "Guardia", f"H{k}") for k, (g, o) in enumerate(zip(others, "Bobusa Cecuvo Dadifo Fugano Gemito Lotiru Mevopa Nurasi Pibelo Rocavu Sodune".split()))]
    sparse = [(f"y{k:02d}", f"{g} Garzía", None, "Guardia", None) for k, g in enumerate(others[: len(rows) - 80])]
    return rows + sparse, len(sparse)


def test_a_sparse_spelling_under_a_crowded_key_is_attached(spark):
    rows, n = crowd()
    got = classes(spark, rows, 4)
    assert got == classes(spark, rows, 10**9)
    assert sum(got[f"y{k:02d}"] == got[f"x{k:02d}"] for k in range(n)) >= 5


def test_blocks_compare_every_pair_once(spark, monkeypatch):
    """Every two blocks meet: the matches of a crowded key are those of brute force."""
    monkeypatch.setattr(names, "BLOCK", 8)
    rows = people(40, 11) + [(f"s{k}", f"{g} García", None, "Guardia", None) for k, g in enumerate(GIVEN_NAMES[:30])]
    named = names.profiles(spark.createDataFrame(rows, SCHEMA)).orderBy("id").withColumn("pid", names.F.monotonically_increasing_id())
    nodes = names.checkpoint(named.select("pid", "perfil").mapInPandas(names._nodes, names.NODE))
    for stage in ("sure", "sparse"):
        got = [tuple(r) for r in names._matches(nodes, stage, -1, 4).collect()]
        own = nodes.collect()
        met = [(x, y) for k, x in enumerate(own) for y in own[k + 1 :] if set(x[stage]) & set(y[stage])]
        brute = [m for x, y in met if (m := names._match(x.pid, y.pid, names._unpack(x.perfil), names._unpack(y.perfil), stage))]
        assert sorted(got) == sorted(brute) and brute


def test_partners_of_one_profile_are_not_held_together():
    """Of any number of partners that are as good, a worker keeps the first (and the last profiles it has read)."""

    def batches():
        for k in range(12):
            packed = [names._pack({f: set() for f in names.FIELDS} | {"first": {"garcia"}, "initials": {"a"}, "licences": {str(n)}}) for n in range(10**6 + k * 4000, 10**6 + k * 4000 + 4000)]
            yield pd.DataFrame({"a": 10**6, "b": range(k * 4000, k * 4000 + 4000), "puntos": 4.0, "perfil": packed})

    names._unpack.cache_clear()
    tracemalloc.start()
    found = pd.concat(names._single_best(batches()))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found.empty and peak < 40e6


def test_no_pair_that_matches_is_passed_over():
    rnd, full = random.Random(2), []
    syllables = ["ka", "qua", "marn", "mam", "lo", "le", "te", "gar", "cia"]
    for _ in range(500):
        word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4))).capitalize()
        given = rnd.choice(["Ana", "A.", "Ana B.", "Alicia", "Ana María"])
        name = rnd.choice(["{g} {x} {y}", "{x} {y}, {g}", "{g} {x}", "{g} {x}{y}", "{x} {i}., {g}"]).format(g=given, x=word(), y=word(), i=word()[0])
        p = {k: set(v) for k, v in parse_name(name).items()} | {
            "licences": set(rnd.choice([[], [], ["123"], ["12345"], ["12354"], ["1234"], ["99999", "12346"]])),
            "specialties": set(rnd.choice([[], ["x"], ["y"]])),
            "institutions": set(rnd.choice([[], ["h"]])),
        }
        full.append(names._union(p, full[-1]) if full and rnd.random() < 0.1 else p)
    traits = np.array([names._traits(p) for p in full], "uint64")
    sure = weak = 0
    for k, p in enumerate(full):
        maybe = {s: names._possible(traits[k], traits.T, s) for s in ("sure", "sparse")}
        for n, q in enumerate(full):
            score = match_score(p, q)
            assert score <= 0 or maybe["sparse"][n], (p, q)
            assert score < 10 or maybe["sure"][n], (p, q)
            sure, weak = sure + (score >= 10), weak + (0 < score < 10)
    assert sure > 500 and weak > 500


def test_words_one_edit_apart_share_a_key():
    rnd = random.Random(1)
    for _ in range(3000):
        a = "".join(rnd.choice("abcdez") for _ in range(rnd.randrange(5, 14)))
        i, how = rnd.randrange(len(a)), rnd.randrange(4)
        b = [a[:i] + a[i + 1 :], a[:i] + "x" + a[i:], a[:i] + "x" + a[i + 1 :], a[:i] + a[i : i + 2][::-1] + a[i + 2 :]][how]
        if len(b) > 4 and distance_one(a, b):
            own = [parse_name(f"Ana {w}") | {"licences": [], "specialties": ["x"], "institutions": []} for w in (a, b)]
            x, y = [blocking_keys({k: set(v) for k, v in p.items()}, "sure") for p in own]
            assert not own[0]["first"] or not own[1]["first"] or x & y, (a, b)

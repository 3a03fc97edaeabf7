"""Keys, episodes, bridge, gate, dedup: literal edges and properties."""

import hashlib
import hmac
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from cordal.functions import keys
from cordal.operators import classify, dedup, episodes, identity, quarantine, runs

SECRET = b"s" * 70


def mac(message, secret=SECRET):
    return hmac.new(secret, message.encode(), hashlib.sha256).digest()[:16].hex()


def test_keys(spark):
    row = (
        spark.createDataFrame([("012.345.678", "pérez  lópez, ana maría", "MP 2736", date(2024, 3, 1))], "d string, n string, m string, f date")
        .select(
            keys.patient_key(F.col("d"), SECRET).alias("p"),
            keys.alternative_key(F.col("n"), F.lit("1950-01-02"), SECRET).alias("a"),
            keys.physician_key(F.col("n"), SECRET).alias("med"),
            keys.licence_key(F.col("m"), SECRET).alias("lic"),
            keys.document_key(F.lit("AB"), b"short").alias("doc"),
            keys.episode_key(F.lit("x"), F.col("f"), SECRET).alias("e"),
            keys.national_id(F.lit("000")).alias("cero"),
            keys.patient_key(F.lit(None).cast("string"), SECRET).alias("nulo"),
        )
        .first()
    )
    assert row.p == mac("12345678")
    assert row.a == mac("alt|PÉREZ LÓPEZ|ANA|1950-01-02")
    assert row.med == mac("medico|PÉREZ LÓPEZ, ANA MARÍA")
    assert row.lic == mac("matricula_medico|2736")
    assert row.doc == mac("documento|ab", b"short")
    assert row.e == mac("x|2024-03-01")
    assert row.cero == "0"


def anchors(spark, rows, days=7):
    df = spark.createDataFrame(rows, "p string, d date, k string, ancla_vieja string")
    out = episodes.anchor_episodes(df, "p", "d", days)
    return {(r.p, r.d, r.k): r.ancla for r in out.collect()}


def test_anchor_window(spark):
    d = date(2024, 1, 1)
    day = lambda n: d + timedelta(days=n)
    got = anchors(spark, [("a", day(0), "x", ""), ("a", day(7), "y", ""), ("a", day(8), "z", ""), ("b", day(6), "x", ""), ("b", day(12), "y", ""), ("b", day(18), "z", ""), (None, d, "q", ""), ("c", None, "q", "")])
    assert got["a", day(7), "y"] == day(0) and got["a", day(8), "z"] == day(8)
    assert got["b", day(12), "y"] == day(6) and got["b", day(18), "z"] == day(18)  # a chain of six-day steps is cut
    assert len(got) == 6


def test_anchor_against_fold(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("aaab"), date(2024, 1, 1) + timedelta(days=rnd.randrange(300)), str(i), "") for i in range(400)]
    got = anchors(spark, rows)
    for p in "ab":
        anchor = None
        for _, day, k, _ in sorted((r for r in rows if r[0] == p), key=lambda r: r[1]):
            anchor = day if anchor is None or (day - anchor).days > 7 else anchor
            assert got[p, day, k] == anchor


def test_gate(spark):
    d = date(2024, 1, 1)
    rows = [("a", d, "ecg"), ("a", d, "lab"), ("b", d, "ecg"), ("b", d, "ecg"), ("c", d, "ecg"), ("e", d, "ecg"), ("e", d, "lab"), ("e", d, "x")]
    df = spark.createDataFrame(rows, "p string, ancla date, k string")
    closed = {r.p: r for r in episodes.gate(df, "p", "k", ["lab", "ecg"]).collect()}
    assert [closed[k].estado for k in "abce"] == ["aprobado", "cuarentena", "cuarentena", "aprobado"]
    assert closed["b"].codigo == "episodio_ambiguo" and closed["c"].codigo == "episodio_incompleto"
    assert closed["b"].faltantes == "lab"
    opened = {r.p: r for r in episodes.gate(df, "p", "k", ["lab", "ecg"], closed=False).collect()}
    assert opened["c"].estado == "pendiente" and opened["b"].estado == "cuarentena"


def test_bridge_is_monotone_and_order_free(spark):
    pairs = spark.createDataFrame([("k", "1"), ("k", "1"), ("h", "1"), ("h", "2"), (None, "1"), ("z", None)], "alt string, pid string")
    bridge = {r.alt: r for r in identity.build_bridge(pairs, "alt", "pid").collect()}
    assert bridge["k"].id_paciente == "1" and bridge["h"].ambiguo and bridge["h"].id_paciente is None
    assert set(bridge) == {"k", "h"}
    again = identity.build_bridge(pairs.where("pid = '1'"), "alt", "pid", identity.build_bridge(pairs, "alt", "pid"))
    assert {r.alt for r in again.where("ambiguo").collect()} == {"h"}
    docs = spark.createDataFrame([(1, "k", None), (2, "h", None), (3, "n", None), (4, "h", "9")], "id int, a string, p string")
    got = {r.id: (r.resuelto, r.codigo) for r in identity.resolve(docs, identity.build_bridge(pairs, "alt", "pid"), "a", "p").collect()}
    assert got == {1: ("1", None), 2: (None, "clave_pii_ambigua"), 3: (None, "clave_pii_no_resuelta"), 4: ("9", None)}


def test_bridge_in_order(spark):
    rows = [(1, "k", None), (2, "k", "7"), (3, "k", None), (4, "k", "8"), (5, "k", None)]
    docs = spark.createDataFrame(rows, "id int, a string, p string")
    got = [r.codigo or r.resuelto for r in identity.resolve_in_order(docs, "a", "p", [], "id").orderBy("id").collect()]
    assert got == ["clave_pii_no_resuelta", "7", "7", "8", "clave_pii_ambigua"]


def test_detect_type(spark):
    rows = [(1, "Hematologia x"), (2, "mortara hematologia"), (3, ""), (4, None), (5, "12sl vent. rate ionograma")]
    got = [r.tipo for r in classify.with_kind(spark.createDataFrame(rows, "id int, t string"), "t").orderBy("id").collect()]
    assert got == ["laboratorio", "desconocido", "desconocido", "desconocido", "ecg"]


def test_dedup_keeps_first_and_counts(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y"), ("d", "x")], "path string, t string")
    out = {r.path: r.es_copia for r in dedup.first_of_content(df, F.col("t"), ["path"]).collect()}
    assert out == {"a": False, "b": True, "c": False, "d": True}


def test_routing(spark):
    files = spark.createDataFrame([("r/a.PDF", 50 * 1024 * 1024), ("r/b.pdf", 50 * 1024 * 1024 + 1), ("r/c.txt", 1), ("r/.h.pdf", 1)], "path string, length long")
    got = {r.path: r.codigo for r in dedup.route(files, ["pdf"]).collect()}
    assert got == {"r/a.PDF": None, "r/b.pdf": "artefacto_sobretamano", "r/c.txt": "formato_no_soportado"}
    paths = spark.createDataFrame([("/r/a",), ("/rx/a",), ("/r/../b",)], "p string")
    assert [r[0] for r in paths.select(dedup.inside_root(F.col("p"), "/r")).collect()] == [True, False, False]


def test_quarantine_first_failure_wins(spark):
    rows = [("r", "d", "b", 2), ("r", "d", "a", 1), ("r", "e", "c", 3), (None, "d", "x", 4), (None, "d", "y", 5)]
    new = spark.createDataFrame(rows, "run string, doc string, codigo string, n int")
    got = sorted(r.codigo for r in quarantine.first_failure(new, new.where("doc = 'e'"), "run", "doc", ["n"]).collect())
    assert got == ["a", "x", "y"]


def test_transitions(spark):
    log = spark.createDataFrame([("a", 1, "creada"), ("a", 2, "inventariando"), ("a", 3, "completada"), ("b", 1, "fallida"), ("b", 2, "procesando")], "k string, v int, s string")
    bad = runs.violations(log, "k", ["v"], "s", runs.RUN_TRANSITIONS).collect()
    assert [(r.k, r.v) for r in bad] == [("a", 3)]
    assert {r.k: r.estado for r in runs.latest(log, "k", ["v"], "s").collect()} == {"a": "completada", "b": "procesando"}


def test_runs_across_slots(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["a", "a", "b", None]), t, rnd.choice(["x", "y", None])) for t in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    whole = {r.t: r.tramo for r in dedup.adjacent_groups(df, "k", ["t"], "v").collect()}
    cut = {r.t: r.tramo for r in dedup.adjacent_groups(df, "k", ["t"], "v", F.floor(F.col("t") / 7)).collect()}
    want, last, count = {}, {}, {}
    for k, t, v in rows:
        if k in last and last[k] != (v,):
            count[k] = count.get(k, 0) + 1
        last[k] = (v,)
        want[t] = count.get(k, 0)
    assert whole == cut == want

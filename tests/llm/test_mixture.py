"""Mixing sources: shares, deviation under one block, caps, edge cases."""

from pathlib import Path

import pytest

from cordal.llm.mixture import in_order, schedule, share_report, tokenizer_path

needs = pytest.mark.skipif(not Path("/opt/tokenizers").exists(), reason="no public tokenizers here")
TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4)]


def corpus(spark, extra=()):
    rows = [(i, "uno dos tres " * (1 + i % 5), ["A ", "b", "C"][0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]) for i in range(400)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, source string")


@needs
def test_shares_and_deviation(spark):
    targets = spark.createDataFrame(TARGETS, "source string, peso double, max_repeticiones int")
    docs = corpus(spark, [(1000, None, "a"), (1001, "", "a"), (1002, "x", None), (1003, "y", "z")])
    blocks = in_order(schedule(docs, targets, tokenizer_path(), chunk=16)).collect()
    total, own, largest = 0, dict.fromkeys("abc", 0), dict.fromkeys("abc", 0)
    for r in blocks:
        largest[r.fuente] = max(largest[r.fuente], r.tokens)
    used = {}
    for r in blocks:
        total += r.tokens
        own[r.fuente] += r.tokens
        used[r.doc_id, r.fuente] = used.get((r.doc_id, r.fuente), 0) + 1
        for name, share, _ in TARGETS:
            assert abs(own[name] - share * total) <= max(largest.values())
    assert max(n for (d, f), n in used.items() if f == "c") <= 4 and max(n for (d, f), n in used.items() if f == "a") == 1
    report = {r.fuente: r for r in share_report(docs, targets, chunk=16).collect()}
    assert all(abs(report[n].cuota - w) < 0.01 for n, w, _ in TARGETS)
    assert report["(otra)"].documentos == 2
    assert sum(r.tokens_mezcla for r in report.values() if r.peso) == total


@needs
def test_chunks_do_not_change_sums(spark):
    targets = spark.createDataFrame(TARGETS, "source string, peso double, max_repeticiones int")
    a = schedule(corpus(spark), targets, chunk=7).agg({"tokens": "sum", "*": "count"}).first()
    b = schedule(corpus(spark), targets, chunk=10_000).agg({"tokens": "sum", "*": "count"}).first()
    assert abs(a[0] - b[0]) <= 3 * 20 * 3


@needs
def test_missing_source_and_empty(spark):
    targets = spark.createDataFrame([*TARGETS, ("d", 0.1, 3)], "source string, peso double, max_repeticiones int")
    report = {r.fuente: r for r in share_report(corpus(spark), targets).collect()}
    assert report["d"].capacidad == 0 and report["a"].tokens_mezcla > 0
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert schedule(empty, targets).count() == 0


@needs
def test_a_stated_total_is_kept_or_falls_short_by_the_caps(spark):
    targets = spark.createDataFrame(TARGETS, "source string, peso double, max_repeticiones int")
    most = max(r.tokens for r in schedule(corpus(spark), targets).collect())
    small = schedule(corpus(spark), targets, total=500).agg({"tokens": "sum"}).first()[0]
    assert 500 - 3 * most <= small <= 500
    report = {r.fuente: r for r in share_report(corpus(spark), targets, total=1_000_000).collect()}
    assert all(report[n].tokens_mezcla == report[n].capacidad and report[n].vueltas == k for n, _, k in TARGETS)

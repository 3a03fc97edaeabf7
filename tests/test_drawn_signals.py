"""Drawn signals at size: many tasks, studies without a number, samples next to their points, rows by ranges."""

import numpy as np
from pyspark.sql import functions as F
from test_signals import strokes

from cordal.operators import signals
from cordal.plans import catalogue


def test_studies_are_dealt(spark, tmp_path):
    ids = spark.range(1, 201).selectExpr("CAST(id AS int) AS id_estudio")
    ids.union(ids.limit(5)).union(spark.sql("SELECT CAST(NULL AS int)")).write.parquet(f"{tmp_path}/medicion_ecg.parquet")
    out = catalogue.queries()["ecg_signal"](spark, str(tmp_path)).withColumn("tarea", F.spark_partition_id()).collect()
    assert len({r.tarea for r in out}) > 1  # the ids alone would be one task
    got = {r.id_estudio: r for r in out}
    assert len(out) == 201 and got[None].entera is None
    assert all(got[n].entera == all(n % k for k in (7, 11, 13)) for n in range(1, 201))
    assert got[3].suma_v1 == 4 * sum(2 * abs(k % 80 - 40) for k in range(5000)) and got[7].suma_v1 is None


def test_samples_are_those_of_interp():
    rnd, work = np.random.default_rng(3), signals.Workspace()
    for count in (signals.LEAD_SAMPLES, signals.STRIP_SAMPLES):
        grid = np.arange(count) / signals.RATE_HZ
        for spread in (0.0, 0.0004, 0.02):  # on the samples, next to them, out of order
            x = grid * signals.MM_PER_S + rnd.uniform(-spread, spread, (3, count)) * signals.MM_PER_S
            uv = rnd.normal(0, 3000, (3, count))
            got = signals._resampled(x, uv, count, work)
            for a, b, line in zip(x, uv, got):
                order = np.argsort(a, kind="stable")
                want = np.rint(np.interp(grid, (a[order] - a[order][0]) / signals.MM_PER_S, b[order]))
                assert (line == want).all()


def test_workspace_serves_many_drawings():
    drawn = [np.array([(p["x"], p["y"]) for p in s]) for s in strokes()[0]]
    uneven = [s[:-1] if i % 3 == 0 and i < 12 else s for i, s in enumerate(drawn)]
    lost = [*drawn[:5], np.where(np.arange(len(drawn[5]))[:, None] == 7, np.nan, drawn[5]), *drawn[6:]]
    work = signals.Workspace()
    for own in (drawn, uneven, drawn[::-1], lost, drawn):
        got, alone = signals.rebuild_axes([s[:, 0] for s in own], [s[:, 1] for s in own], work), signals.rebuild_signal(own)
        assert (got is None) == (alone is None) == (own is lost)
        assert got is None or all((a == b).all() for a, b in zip(got, alone))


def test_rows_by_ranges_or_medians():
    apart = [np.array([0.0, 1.0, 2.0]) + 60 * (i % 3) for i in range(12)]
    crossing = [np.array([0.0, 0.0, 200.0]) + 60 * (i % 3) for i in range(12)]
    for heights in (apart, crossing):
        rows = signals._rows([h.min() for h in heights], [h.max() for h in heights], heights)
        assert rows == [i % 3 for i in range(12)]
    ranges = [(0.0, 200.0), (60.0, 260.0), (120.0, 320.0)]
    assert signals._bands([1.0, 61.0, 121.0], ranges, [[h] for h in crossing[:3]]) == [0, 1, 2]

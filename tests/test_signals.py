"""Signal operators: codec round trips, partition, reconstruction of a synthetic ECG."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cordal.operators import signals


def test_codec_round_trip():
    rnd = np.random.default_rng(1)
    x = rnd.integers(-32768, 32767, 999).astype(np.int16)
    m = rnd.random(999) < 0.5
    assert (signals.decode_samples(signals.encode_samples(x), 999) == x).all()
    assert (signals.decode_mask(signals.encode_mask(m), 999) == m).all()
    with pytest.raises(ValueError):
        signals.decode_samples(signals.encode_samples(x), 998)
    with pytest.raises(ValueError):
        signals.decode_mask(signals.encode_mask(m), 999, version=9)


def test_statistics(spark):
    rnd = np.random.default_rng(2)
    a, b = rnd.normal(size=50), rnd.normal(size=50)
    df = spark.createDataFrame([(a.tolist(), b.tolist(), [])], "a array<double>, b array<double>, e array<double>")
    r = df.select(signals.rms(F.col("a")), signals.deviation(F.col("a")), signals.correlation(F.col("a"), F.col("b")), signals.rms(F.col("e"))).first()
    assert r[0] == pytest.approx(np.sqrt((a * a).mean())) and r[1] == pytest.approx(a.std())
    assert r[2] == pytest.approx(np.corrcoef(a, b)[0, 1]) and r[3] is None


def strokes(flip=1.0, height=10.0, swap=False):
    """Twelve leads in a 4 x 3 grid, a strip and four pulses, in millimetres."""
    t = np.arange(signals.LEAD_SAMPLES) / signals.RATE_HZ
    one, three = np.sin(7 * t), 0.5 * np.cos(5 * t)
    two = one + three
    limb = {"I": one, "II": two, "III": three, "aVR": -(one + two) / 2, "aVL": (one - three) / 2, "aVF": (two + three) / 2}
    ts = np.arange(signals.STRIP_SAMPLES) / signals.RATE_HZ
    strip = np.sin(3 * ts)
    out = []
    for i, name in enumerate(signals.LEADS):
        c, r = divmod(i, 3)
        start = signals.COLUMN_OFFSETS[c]
        mv = limb.get(name, strip[start : start + signals.LEAD_SAMPLES] * (1 if name == "V1" else 0.3))
        if swap and name == "II":
            mv = -mv
        x = (start / signals.RATE_HZ + t) * signals.MM_PER_S + 20
        out.append([{"x": float(flip * a), "y": float(30.0 * r - 10 * v)} for a, v in zip(x, mv)])
    out.append([{"x": float(flip * a), "y": float(90.0 - 10 * v)} for a, v in zip(ts * signals.MM_PER_S + 20, strip)])
    for r in range(4):
        base = 30.0 * r
        out.append([{"x": flip * x, "y": y} for x, y in [(5.0, base), (7.0, base), (7.0, base - height), (12.0, base - height), (12.0, base)]])
    return out, strip


def test_rebuild(spark):
    drawn, strip = strokes()
    samples, mask = signals.rebuild_signal(drawn)
    assert samples.shape == (12, 5000) and mask[6].all() and mask[0].sum() == signals.LEAD_SAMPLES
    assert np.abs(samples[6] - 1000 * strip).max() <= 2
    assert signals.rebuild_signal(strokes(flip=-1.0)[0]) is not None  # mirrored paper
    assert signals.rebuild_signal(strokes(height=9.0)[0]) is None  # bad calibration
    assert signals.rebuild_signal(strokes(swap=True)[0]) is None  # not physiological
    assert signals.rebuild_signal(drawn[:-1]) is None and signals.rebuild_signal(None) is None
    df = spark.createDataFrame([(1, drawn), (2, None)], f"id int, s {signals.STROKES}")
    got = {r.id: r.senal.muestras for r in signals.with_signal(df, "s").collect()}
    assert len(got[1]) == 12 and got[2] is None


def test_gap_partition(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 10, 11, 30, 31)] + [("b", 5)], "k string, v int")
    got = {(r.k, r.v): r.grupo for r in signals.gap_partition(df, "k", "v", 3).collect()}
    assert [got["a", v] for v in (1, 2, 10, 11, 30, 31)] == [0, 0, 1, 1, 2, 2] and got["b", 5] == 0


def test_nearest_index(spark):
    df = spark.createDataFrame([([1.0, 9.0], [10.0, 0.0]), ([1.0, 2.0], [0.0, 50.0])], "v array<double>, r array<double>")
    assert [r[0] for r in df.select(signals.nearest_index(F.col("v"), F.col("r"))).collect()] == [[1, 0], None]

"""Array signals: statistics, partition by gaps, stroke reconstruction, codec."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cordal.operators.ordered import with_previous
from cordal.session import ship

#: Fixed values of the recorded layout: rate, samples, column offsets, paper scales, tolerances.
RATE_HZ = 500
LEAD_SAMPLES = 1238
STRIP_SAMPLES = 5000
SAMPLE_TOLERANCE = 2
COLUMN_OFFSETS = (0, 1250, 2500, 3750)
MM_PER_S = 25.0
MM_PER_MV = 10.0
TOLERANCE = 0.02
MAX_UV = 32767
LEADS = ("I", "II", "III", "aVR", "aVL", "aVF", "V1", "V2", "V3", "V4", "V5", "V6")
RESIDUE_LIMIT = 0.20
CORRELATION_LIMIT = 0.8
#: Fixed values of the stroke filter: black, unfilled, this width in points.
STROKE_WIDTH_PT = 0.43
STROKE_WIDTH_TOLERANCE = 0.20
FORMAT_VERSION = 1

STROKES = "array<array<struct<x:double,y:double>>>"
SIGNAL = "struct<muestras:array<array<smallint>>,mascara:array<array<boolean>>>"


def _sum(array: Column, f) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + f(x.cast("double")))


def rms(array: Column) -> Column:
    """Root mean square; null for an empty array."""
    return F.when(F.size(array) > 0, F.sqrt(_sum(array, lambda x: x * x) / F.size(array)))


def mean(array: Column) -> Column:
    return F.when(F.size(array) > 0, _sum(array, lambda x: x) / F.size(array))


def deviation(array: Column) -> Column:
    """Population standard deviation."""
    m = mean(array)
    return F.when(F.size(array) > 0, F.sqrt(F.greatest(_sum(array, lambda x: x * x) / F.size(array) - m * m, F.lit(0.0))))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of two arrays of equal length, else null."""
    n = F.size(a).cast("double")
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    sa, sb = _sum(a, lambda x: x), _sum(b, lambda x: x)
    va = n * _sum(a, lambda x: x * x) - sa * sa
    vb = n * _sum(b, lambda x: x * x) - sb * sb
    return F.when(
        (F.size(a) == F.size(b)) & (va > 0) & (vb > 0), (n * _sum(products, lambda x: x) - sa * sb) / F.sqrt(va * vb)
    )


def decimated(array: Column, step: int = 2) -> Column:
    """Every ``step``-th element from the first."""
    return F.filter(array, lambda x, i: i % step == 0)


def gap_partition(df: DataFrame, key: str, value: str, parts: int, slot: Column | None = None) -> DataFrame:
    """``grupo`` 0..parts-1: values of a key cut at its ``parts - 1`` largest gaps.

    Equal gaps are cut from the smaller value on. ``slot`` never falls in ``value``;
    it spreads a large key. Only the cuts of a key, fewer than ``parts``, are brought
    together, with a limit before the shuffle, and joined back.
    """
    rows = with_previous(df, key, [value], value, F.lit(0) if slot is None else slot, "_antes")
    gaps = rows.where(~F.col("_primera")).select(F.col(key).alias("_k"), F.col(value).alias("_v"), (F.col(value) - F.col("_antes")).alias("_gap"))
    rank = F.row_number().over(W.partitionBy("_k").orderBy(F.desc("_gap"), "_v"))
    cuts = gaps.withColumn("_n", rank).where(F.col("_n") < parts).groupBy("_k").agg(F.collect_list("_v").alias("_cortes"))
    out = df.join(cuts, df[key].eqNullSafe(cuts["_k"]), "left")
    count = F.size(F.filter("_cortes", lambda c: c <= F.col(value))).cast("long")
    return out.withColumn("grupo", F.when(F.col("_cortes").isNull(), F.lit(0).cast("long")).otherwise(count)).drop("_k", "_cortes")


def nearest_index(values: Column, references: Column) -> Column:
    """Index of the nearest reference of each value; null unless it is a bijection."""
    nearest = F.transform(
        values,
        lambda v: F.array_position(
            F.transform(references, lambda r: F.abs(r - v)), F.array_min(F.transform(references, lambda r: F.abs(r - v)))
        ).cast("int")
        - 1,
    )
    return F.when(
        (F.size(F.array_distinct(nearest)) == F.size(values)) & (F.size(values) == F.size(references)), nearest
    )


def usable_strokes(drawings: Column) -> Column:
    """Black unfilled drawings of the trace width, in millimetres.

    ``drawings``: array<struct<color,fill,width,items:array<struct<x,y>>>> in points.
    """
    low, high = STROKE_WIDTH_PT * (1 - STROKE_WIDTH_TOLERANCE), STROKE_WIDTH_PT * (1 + STROKE_WIDTH_TOLERANCE)
    kept = F.filter(
        drawings, lambda d: (d["color"] == "black") & d["fill"].isNull() & (d["width"] >= low) & (d["width"] <= high)
    )
    mm = lambda v: v * F.lit(25.4 / 72)
    return F.transform(
        kept, lambda d: F.transform(d["items"], lambda p: F.struct(mm(p["x"]).alias("x"), mm(p["y"]).alias("y")))
    )


def stroke_kind(points: Column) -> Column:
    """lead, strip, pulse or null by the number of points."""
    n = F.size(points)
    return (
        F.when(F.abs(n - LEAD_SAMPLES) <= SAMPLE_TOLERANCE, "derivacion")
        .when(F.abs(n - STRIP_SAMPLES) <= SAMPLE_TOLERANCE, "tira")
        .when(n <= 100, "pulso")
    )


def _clusters(values: list[float], k: int) -> list[int] | None:
    """Cluster number of each value after cutting at the k-1 largest gaps."""
    if len(values) < k:
        return None
    order = sorted(range(len(values)), key=values.__getitem__)
    gaps = [values[j] - values[i] for i, j in zip(order, order[1:])]
    cuts = {i + 1 for i in sorted(range(len(gaps)), key=lambda i: -gaps[i])[: k - 1]}
    label, part = [0] * len(values), 0
    for n, at in enumerate(order):
        part += n in cuts
        label[at] = part
    return label


def _rows(low: list[float], high: list[float], heights: list[np.ndarray]) -> list[int] | None:
    """Row of each lead by the median of its heights.

    A median lies between lowest and highest point. Where groups of these ranges
    are farther apart than each is wide, they decide and no median is taken.
    """
    rows = _clusters(low, 3)
    of = lambda values, r: [v for v, k in zip(values, rows) if k == r]
    ranges = [(min(of(low, r)), max(of(high, r))) for r in range(3)]
    if min(ranges[1][0] - ranges[0][1], ranges[2][0] - ranges[1][1]) > max(h - l for l, h in ranges):
        return rows
    return _clusters([float(np.median(a)) for a in heights], 3)


def _bands(feet: list[float], ranges: list[tuple[float, float]], heights: list[list[np.ndarray]]) -> list[int]:
    """The band of the nearest median of each foot, from the bands' ranges where these decide."""
    near = []
    for f in feet:
        most = [max(h - f, f - l) for l, h in ranges]
        best = most.index(min(most))
        if any(max(l - f, f - h, 0.0) <= most[best] for k, (l, h) in enumerate(ranges) if k != best):
            medians = np.array([np.median(np.concatenate(b)) for b in heights])
            return [int(np.argmin(np.abs(medians - x))) for x in feet]
        near.append(best)
    return near


class Workspace:
    """Arrays that serve one signal after the other: mapping new memory for each would take longer than the arithmetic."""

    def __init__(self) -> None:
        self._kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, int], kind: type = float) -> np.ndarray:
        size = shape[0] * shape[1]
        if name not in self._kept or self._kept[name].size < size:
            self._kept[name] = np.empty(size, kind)
        return self._kept[name][:size].reshape(shape)


def _resampled(xs: np.ndarray, uv: np.ndarray, count: int, work: Workspace) -> np.ndarray | None:
    """``count`` samples at the recorded rate of each line, by linear interpolation, or None.

    Where every point lies less than half a step from its sample, the two points
    around a sample are known; that gives the numbers of ``np.interp`` without its search.
    """
    seconds, grid = count / RATE_HZ, np.arange(count) / RATE_HZ
    lines, points = xs.shape
    t = work("t", xs.shape)
    np.divide(np.subtract(xs, xs[:, :1], out=t), MM_PER_S, out=t)
    last = t[:, -1]
    off = np.subtract(grid, t, out=work("off", xs.shape)) if points == count else None
    if off is not None and -0.5 / RATE_HZ < (least := off.min()) and off.max() < 0.5 / RATE_HZ:
        out, slope, step = work("out", xs.shape), work("slope", (1, t.size - 1))[0], work("step", (1, t.size - 1))[0]
        u, v, at, by = uv.reshape(-1), out.reshape(-1), t.reshape(-1), off.reshape(-1)  # all lines in a row: the slope between two lines is not used
        np.subtract(u[1:], u[:-1], out=slope)
        slope /= np.subtract(at[1:], at[:-1], out=step)
        np.add(np.multiply(slope, by[:-1], out=step), u[:-1], out=v[:-1])
        out[:, -1] = uv[:, -1]
        if least < 0:  # the sample lies before its point
            before = by[1:] < 0
            np.copyto(off, grid)
            np.multiply(slope, np.subtract(by[1:], at[:-1], out=step), out=step)
            step += u[:-1]
            np.putmask(v[1:], before, step)
    else:
        order = np.argsort(xs, axis=1, kind="stable")
        xs, uv = np.take_along_axis(xs, order, 1), np.take_along_axis(uv, order, 1)
        t = (xs - xs[:, :1]) / MM_PER_S
        if not np.isfinite(uv).all():
            return None
        out, last = np.array([np.interp(grid, a, b) for a, b in zip(t, uv)]), t[:, -1]
    if np.abs(last - seconds).max() > TOLERANCE * seconds:
        return None
    np.rint(out, out=out)
    return out.astype(np.int16) if out.max() <= MAX_UV and out.min() >= -MAX_UV else None


def rebuild_signal(strokes: list) -> tuple[np.ndarray, np.ndarray] | None:
    """``rebuild_axes`` of strokes that are lists of points or arrays of two columns."""
    arrays = [np.array([(p["x"], p["y"]) for p in s], float) if isinstance(s, list) else s for s in strokes or [] if len(s) > 1]
    return rebuild_axes([a[:, 0] for a in arrays], [a[:, 1] for a in arrays])


def rebuild_axes(xs: list[np.ndarray], ys: list[np.ndarray], work: Workspace | None = None) -> tuple[np.ndarray, np.ndarray] | None:
    """12 x 5000 samples in microvolts and their mask; None on any violation.

    ``xs`` and ``ys``: the coordinates of each stroke. Vertical axis grows downwards. Four
    rows of the grid (three of leads, one strip) each have a calibration pulse of ten millimetres.
    With ``work`` the result holds until the next call with it.
    """
    work = work or Workspace()
    kinds: dict[str, list[int]] = {"lead": [], "strip": [], "pulse": []}
    for i, a in enumerate(xs):
        n = len(a)
        if n < 2:
            continue
        if abs(n - LEAD_SAMPLES) <= SAMPLE_TOLERANCE:
            kinds["lead"].append(i)
        elif abs(n - STRIP_SAMPLES) <= SAMPLE_TOLERANCE:
            kinds["strip"].append(i)
        elif n <= 100:
            kinds["pulse"].append(i)
        else:
            return None
    if [len(kinds[k]) for k in ("lead", "strip", "pulse")] != [12, 1, 4]:
        return None
    lengths: dict[int, list[int]] = {}  # lines of one length are one array; as a rule that is all leads, and the strip
    for i in kinds["lead"]:
        lengths.setdefault(len(xs[i]), []).append(i)
    stacks = []
    for own in [*lengths.values(), kinds["strip"]]:
        shape = (len(own), len(xs[own[0]]))
        x, y = work(f"x{len(stacks)}", shape), work(f"y{len(stacks)}", shape)
        for of, to in ((xs, x), (ys, y)):
            np.concatenate([of[i] for i in own], out=to.reshape(-1))
        stacks.append((own, x, y))
    pulses = [(xs[i].tolist(), ys[i].tolist()) for i in kinds["pulse"]]
    low, high = {}, {}
    for own, _, y in stacks:
        low.update(zip(own, y.min(axis=1).tolist()))
        high.update(zip(own, y.max(axis=1).tolist()))
    body_x = sum(float(x.sum()) for _, x, _ in stacks) / sum(x.size for _, x, _ in stacks)
    if not math.isfinite(body_x) or any(v != v for v in low.values()) or any(v != v for p in pulses for a in p for v in a):
        return None
    forward = sum(sum(x) / len(x) for x, _ in pulses) / len(pulses) <= body_x  # pulses stand where time begins
    if not forward:
        for _, x, _ in stacks:
            np.negative(x, out=x)
    feet, scale = [], []
    for x, y in pulses:
        base = y[x.index(min(x) if forward else max(x))]
        top = max(y, key=lambda v: abs(v - base))
        height = base - top
        if abs(abs(height) - MM_PER_MV) > TOLERANCE * MM_PER_MV:
            return None
        feet.append(base)
        scale.append(1000.0 / height)
    if len({s > 0 for s in scale}) != 1:
        return None
    begin = {i: v for own, x, _ in stacks for i, v in zip(own, x.min(axis=1).tolist())}
    leads, strip = kinds["lead"], kinds["strip"][0]
    columns = _clusters([begin[i] for i in leads], 4)
    rows = _rows([low[i] for i in leads], [high[i] for i in leads], [ys[i] for i in leads])
    if columns is None or rows is None or len({*zip(columns, rows)}) != 12:
        return None
    bands = [*([i for i, r in zip(leads, rows) if r == k] for k in range(3)), [strip]]
    near = _bands(feet, [(min(low[i] for i in b), max(high[i] for i in b)) for b in bands], [[ys[i] for i in b] for b in bands])
    if len(set(near)) != 4:
        return None
    base_of = {b: (f, s) for b, f, s in zip(near, feet, scale)}
    place = {i: (c, r) for i, c, r in zip(leads, columns, rows)} | {strip: (0, 3)}
    samples, mask = work("samples", (12, STRIP_SAMPLES), np.int16), work("mask", (12, STRIP_SAMPLES), bool)
    samples.fill(0)
    mask.fill(False)
    for own, x, y in stacks:
        foot, factor = (np.array([base_of[place[i][1]][k] for i in own])[:, None] for k in (0, 1))
        np.multiply(np.subtract(foot, y, out=y), factor, out=y)
        got = _resampled(x, y, STRIP_SAMPLES if own == [strip] else LEAD_SAMPLES, work)
        if got is None:
            return None
        if own == [strip]:
            whole = got[0]
            continue
        for i, line in zip(own, got):
            c, r = place[i]
            at = slice(COLUMN_OFFSETS[c], COLUMN_OFFSETS[c] + LEAD_SAMPLES)
            samples[3 * c + r, at], mask[3 * c + r, at] = line, True
    if not _plausible(samples, whole):
        return None
    v1 = LEADS.index("V1")
    samples[v1], mask[v1] = whole, True
    return samples, mask


def _plausible(samples: np.ndarray, strip: np.ndarray) -> bool:
    """Einthoven, Goldberger and agreement of V1 with the rhythm strip."""
    part = lambda name, c: samples[LEADS.index(name), COLUMN_OFFSETS[c] :][:LEAD_SAMPLES].astype(float)
    one, two, three = (part(n, 0) for n in ("I", "II", "III"))
    r, left, f = (part(n, 1) for n in ("aVR", "aVL", "aVF"))
    size = lambda x: float(np.sqrt((x * x).sum() / len(x)))
    if size(two - one - three) > RESIDUE_LIMIT * max(size(two), 1e-9):
        return False
    if size(r + left + f) > RESIDUE_LIMIT * max(size(r), size(left), size(f), 1e-9):
        return False
    a, b = part("V1", 2), strip[COLUMN_OFFSETS[2] :][:LEAD_SAMPLES].astype(float)
    a, b = a - a.mean(), b - b.mean()
    spread = float(np.sqrt((a * a).sum() * (b * b).sum()))
    return spread > 0 and float((a * b).sum()) >= CORRELATION_LIMIT * spread


def with_signal(df: DataFrame, strokes: str) -> DataFrame:
    """``df`` with ``senal`` (samples and mask) of its strokes; null parts where they do not fit."""

    ship(df.sparkSession)
    kind = pa.struct([("muestras", pa.list_(pa.list_(pa.int16()))), ("mascara", pa.list_(pa.list_(pa.bool_())))])

    def rebuilt(column: pa.Array) -> pa.Array:
        rows, work = [], Workspace()
        points = column.values.values  # strokes are ragged: one flat view of all points, cut by the offsets
        x, y = (np.asarray(points.field(c).fill_null(np.nan), float) for c in ("x", "y"))
        outer, inner = np.asarray(column.offsets), np.asarray(column.values.offsets)
        for n, known in enumerate(column.is_valid().to_pylist()):
            own = [slice(inner[i], inner[i + 1]) for i in range(outer[n], outer[n + 1])] if known else []
            found = rebuild_axes([x[s] for s in own], [y[s] for s in own], work) if known else None
            rows.append({"muestras": None, "mascara": None} if found is None else {"muestras": list(found[0].copy()), "mascara": list(found[1].copy())})
        return pa.array(rows, kind)

    return df.withColumn("senal", F.arrow_udf(rebuilt, SIGNAL)(strokes))


def encode_samples(samples) -> bytes:
    return zlib.compress(np.asarray(samples, "<i2").tobytes())


def decode_samples(data: bytes, count: int, version: int = FORMAT_VERSION) -> np.ndarray:
    """Samples of a stored block; an unknown version or another length is an error."""
    if version != FORMAT_VERSION:
        raise ValueError(f"unknown signal format {version}")
    out = np.frombuffer(zlib.decompress(data), "<i2")
    if len(out) != count:
        raise ValueError(f"{len(out)} samples instead of {count}")
    return out


def encode_mask(mask) -> bytes:
    return zlib.compress(np.packbits(np.asarray(mask, bool)).tobytes())


def decode_mask(data: bytes, count: int, version: int = FORMAT_VERSION) -> np.ndarray:
    if version != FORMAT_VERSION:
        raise ValueError(f"unknown signal format {version}")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8))
    if not count <= len(bits) < count + 8:
        raise ValueError(f"mask of {len(bits)} bits instead of {count}")
    return bits[:count].astype(bool)


def through_codec(df: DataFrame, key: str, samples: str, mask: str) -> DataFrame:
    """key, bytes, the samples (as smallint) and the mask after encoding and decoding."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, x, m in zip(batch[key], batch[samples], batch[mask]):
                data, bits = encode_samples(x), encode_mask(m)
                out.append((k, len(data) + len(bits), decode_samples(data, len(x)).tolist(), decode_mask(bits, len(m)).tolist()))
            yield pd.DataFrame(out, columns=[key, "bytes", "vuelta", "mascara"])

    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, F.col(samples).cast("array<smallint>"), mask)
    return rows.mapInPandas(run, f"{key} {kind}, bytes int, vuelta array<smallint>, mascara array<boolean>")

"""Episodes over a stream: an episode closes when the watermark passes its window.

Documents of a patient wait in state until no earlier document can come; then the
same fixed-anchor fold as in batch runs over the days that are complete. State per
patient holds only documents of episodes that are still open.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "paciente string, ancla date, documentos int, faltantes string, motivo string, estado string"


def _fold(docs: list[list], window_days: int) -> list[tuple[date, list[list]]]:
    """(anchor, documents) in order of a list of [iso day, type, id]."""
    out: list[tuple[date, list[list]]] = []
    for doc in sorted(docs):
        day = date.fromisoformat(doc[0])
        if not out or (day - out[-1][0]).days > window_days:
            out.append((day, []))
        out[-1][1].append(doc)
    return out


def _split(waiting: list[list], new: set[tuple[str, str, str, bool]]) -> tuple[list[list], dict[str, int]]:
    """(documents of open episodes, late ones per day).

    A document behind the watermark still joins an open episode whose anchor is
    not after it; before that anchor an episode may already be out.
    """
    docs = sorted({tuple(d) for d in waiting} | {d[:3] for d in new if not d[3]})
    anchor = min((d[0] for d in waiting), default=None)
    late: dict[str, int] = {}
    for *doc, behind in sorted(new):
        if not behind or tuple(doc) in docs:
            continue
        if anchor is not None and doc[0] >= anchor:
            docs.append(tuple(doc))
        else:
            late[doc[0]] = late.get(doc[0], 0) + 1
    return [list(d) for d in sorted(set(docs))], late


def _verdict(docs: list[list], required: list[str]) -> tuple[str, str | None, str]:
    kinds = [d[1] for d in docs]
    missing = ",".join(sorted(set(required) - set(kinds)))
    if len(set(kinds)) < len(kinds):
        return missing, "asociacion_ambigua", "cuarentena"
    return (missing, "estudios_faltantes", "cuarentena") if missing else ("", None, "aprobado")


def closing_episodes(
    stream: DataFrame, patient: str, moment: str, kind: str, doc: str, required: list[str],
    window_days: int = 7, lateness: str = "1 day",
) -> DataFrame:
    """One row per episode once it can no longer change.

    Documents later than ``lateness`` behind the newest one are kept: they join an
    episode that is open, else they are a quarantine row of their day with motive
    ``documento_tardio``. An episode that is out never changes.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting = json.loads(state.get[0]) if state.exists else []
        mark = state.getCurrentWatermarkMs()
        now = datetime.fromtimestamp(mark / 1000, timezone.utc).date()
        new = set()
        for batch in batches:
            for when, k, d, late, clock in zip(batch["_t"], batch["_k"], batch["_d"], batch["_ms"], batch["_w"]):
                if pd.isna(clock):
                    new.add((pd.Timestamp(when).date().isoformat(), k, d, mark > 0 and late <= mark))
        docs, late_days = _split(waiting, new)
        rows = [(key[0], date.fromisoformat(day), n, "", "documento_tardio", "cuarentena") for day, n in late_days.items()]
        keep = []
        for anchor, members in _fold(docs, window_days):
            if anchor + timedelta(days=window_days) < now:
                missing, motive, verdict = _verdict(members, required)
                rows.append((key[0], anchor, len(members), missing, motive, verdict))
            else:
                keep += members
        if keep:
            state.update((json.dumps(keep),))
            first = date.fromisoformat(keep[0][0]) + timedelta(days=window_days + 1)
            due = datetime(first.year, first.month, first.day, tzinfo=timezone.utc)
            state.setTimeoutTimestamp(max(int(due.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])

    rows = stream.where(F.col(patient).isNotNull() & F.col(moment).isNotNull()).select(
        F.col(patient).cast("string").alias("_p"), F.col(moment).cast("timestamp").alias("_t"),
        F.col(kind).alias("_k"), F.col(doc).cast("string").alias("_d"),
    )
    # the watermark drops rows by _w: a document goes without it, its copy with it only moves the watermark
    rows = rows.withColumn("_ms", F.unix_millis("_t"))
    twice = F.explode(F.array(F.col("_t"), F.lit(None).cast("timestamp")))
    return (
        rows.withColumn("_w", twice)
        .withWatermark("_w", lateness)
        .groupBy("_p")
        .applyInPandasWithState(update, OUT, "docs string", "append", GroupStateTimeout.EventTimeTimeout)
    )


def idempotent_sink(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: a batch that is written again replaces itself.

    Each micro-batch has its own folder, so a retry after a lost executor or driver
    never doubles rows; keys that an earlier batch has written are left out. Rows
    without a key are always written.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = batch.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(batch.where(F.col(key).isNull()))
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(folder) and any(s.getPath().getName().startswith("lote=") for s in files.listStatus(folder)):
            before = spark.read.schema(f"`{key}` {batch.schema[key].dataType.simpleString()}, lote bigint").parquet(path)
            new = new.join(before.where(F.col("lote") < epoch).select(key), key, "left_anti")
        new.select(*batch.columns).write.mode("overwrite").parquet(f"{path}/lote={epoch}")

    return write

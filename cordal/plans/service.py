"""Control of runs: retries with delays, one active run, retry of what may be retried.

What a process pool would do by hand is the scheduler's: tasks in flight are bounded
by the executors' cores (T03, T05), the tasks of a lost executor run again elsewhere
(T04), and ``stop`` cancels the jobs of a run (T06).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordal.operators import quarantine, runs

T = TypeVar("T")
#: Seconds before the second, third and fourth attempt.
DELAYS = (5, 30, 180)


class TransientExhausted(RuntimeError):
    """All attempts of a stage failed for reasons that pass by themselves."""

    codigo = "error_transitorio_agotado"

    def __init__(self, stage: str):
        super().__init__(f"{self.codigo}: {stage}")
        self.etapa = stage


class RunConflict(RuntimeError):
    """The state of the run does not allow what was asked for (an HTTP service answers 409)."""


def retried(action: Callable[[], T], stage: str, transient: tuple[type[Exception], ...] = (OSError,), delays=DELAYS, sleep=time.sleep) -> T:
    """The result of ``action``; transient errors are tried again, all others pass at once."""
    for n, delay in enumerate((*delays, None)):
        try:
            return action()
        except transient as error:
            if delay is None:
                raise TransientExhausted(stage) from error
            sleep(delay)
    raise AssertionError("unreachable")


def once(rows: Iterator[T]) -> Iterator[T]:
    """An iterator that refuses a second pass instead of being silently empty."""
    used = False

    class Once:
        def __iter__(self) -> Iterator[T]:
            nonlocal used
            if used:
                raise RuntimeError("this stream has been read")
            used = True
            return iter(rows)

    return Once()


@dataclass
class Memo:
    """A value that is computed again once it is older than ``seconds``."""

    compute: Callable[[], object]
    seconds: float = 1.0
    clock: Callable[[], float] = time.monotonic
    _kept: tuple[float, object] | None = field(default=None, init=False)

    def __call__(self) -> object:
        now = self.clock()
        if self._kept is None or now - self._kept[0] >= self.seconds:
            self._kept = now, self.compute()
        return self._kept[1]


@dataclass
class RunService:
    """Create, advance, query and retry runs over an append-only log of states in ``folder``."""

    spark: SparkSession
    folder: str

    _SCHEMA = "corrida string, version int, estado string"

    def _log(self) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        known = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(self._SCHEMA).parquet(self.folder) if known else self.spark.createDataFrame([], self._SCHEMA)

    def _append(self, run: str, version: int, state: str) -> None:
        row = self.spark.createDataFrame([(run, version, state)], self._SCHEMA).coalesce(1)
        retried(lambda: row.write.mode("append").parquet(self.folder), "control")

    def states(self) -> DataFrame:
        """Last state of every run, in order of their ids."""
        return runs.latest(self._log(), "corrida", ["version"], "estado").orderBy("corrida")

    def query(self, run: str) -> tuple[str, int]:
        """State and version of one run."""
        found = self.states().where(F.col("corrida") == run).first()
        if found is None:
            raise KeyError(run)
        return found["estado"], found["cambios"]

    def create(self, run: str) -> None:
        """Start a run; refused while another one is not closed."""
        states = self.states()
        if not states.where(F.col("corrida") == run).isEmpty() or not runs.open_runs(states, "estado").isEmpty():
            raise RunConflict(run)
        self._append(run, 1, "creada")

    def advance(self, run: str, state: str, version: int) -> None:
        """The next state, if it may follow and nobody has moved the run since ``version``."""
        before, known = self.query(run)
        if known != version or state not in runs.RUN_TRANSITIONS[before]:
            raise RunConflict(f"{run}: {before} to {state}")
        self._append(run, version + 1, state)

    def retry(self, run: str, quarantined: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
        """The documents to process again, with their addresses; the run is open again."""
        state, version = self.query(run)
        wanted, homeless, _ = quarantine.retry_plan(quarantined, inventory, key)
        if not homeless.isEmpty():
            raise RunConflict(f"{run}: retryable documents without an address")
        self.advance(run, "procesando", version)
        return wanted

    def stop(self, run: str) -> None:
        """Cancel the jobs of a run; its last state stays and it can be resumed."""
        self.spark.sparkContext.cancelJobGroup(run)

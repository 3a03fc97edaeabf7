"""A pipeline of named DataFrame stages; errors are values, split once at the end."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class EntityDetector(Protocol):
    """Finds (inicio, fin, tipo) spans in a text column; a model or a set of rules."""

    def __call__(self, df: DataFrame, text: str) -> DataFrame: ...


class Sink(Protocol):
    """Takes the rows of one outcome (X11)."""

    def __call__(self, rows: DataFrame) -> None: ...


@dataclass
class Pipeline:
    """Stages run in order; a row that got a ``codigo`` passes the later ones untouched."""

    stages: list[tuple[str, Callable[[DataFrame], DataFrame]]] = field(default_factory=list)

    def add(self, name: str, stage: Callable[[DataFrame], DataFrame]) -> Pipeline:
        self.stages.append((name, stage))
        return self

    def run(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(published, quarantined): every input row is in exactly one of them."""
        if "codigo" not in df.columns:
            df = df.withColumns({"codigo": F.lit(None).cast("string"), "etapa": F.lit(None).cast("string")})
        live, held = df.where("codigo IS NULL"), [df.where("codigo IS NOT NULL")]
        for name, stage in self.stages:
            done = stage(live)
            held.append(done.where("codigo IS NOT NULL").withColumn("etapa", F.coalesce("etapa", F.lit(name))))
            live = done.where("codigo IS NULL")
        return live.drop("codigo", "etapa"), reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), held)


class Registry:
    """Kind to transform; an unknown kind is an error where it is asked for."""

    def __init__(self, **known: Callable[[DataFrame], DataFrame]) -> None:
        self.known = known

    def __getitem__(self, kind: str) -> Callable[[DataFrame], DataFrame]:
        if kind not in self.known:
            raise KeyError(f"tipo_no_reconocido: {kind}")
        return self.known[kind]

    def apply(self, df: DataFrame, kind: str) -> dict[str, DataFrame]:
        """One DataFrame per kind, each through its own transform."""
        return {k: f(df.where(F.col(kind) == k)) for k, f in self.known.items()}

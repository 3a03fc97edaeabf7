"""Entity-attribute-value rows to one wide row per entity, with typed columns.

Attributes are encoded as column indices: once per distinct spelling of name and
section, joined back (broadcast when its counted size is bounded). Every Arrow batch is reduced to its winning rows before the shuffle, so
an entity that holds a third of all rows sends at most one row per cell and
batch. After one shuffle by entity the rows are sorted within the partition
and streamed into sparse columnar builders: per batch one value buffer and one
validity mask per column. Only the winners of the entity that is still open are
carried to the next batch, so memory does not depend on the size of a group.

Defined results
---------------
* null entity, unknown attribute: no cell (an entity without any cell: no row).
* several rows of one cell: the largest row id with a value of that kind wins;
  repeated rows count once; equal ids with different values: the larger value.
* empty table: no rows, the same schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordal.operators.analytes import analyte_names, name_base, name_key, section_key
from cordal.session import bounded, lookup, ship

#: A wide table has at most this many attributes.
MAX_COLUMNS = 10_000

_LONG = "entidad bigint, columna int, fila bigint, num double, texto string, unidad string"
_LAST = pa.schema(
    [("entidad", pa.int64()), ("columna", pa.int32()), ("fila", pa.int64()),
     ("num", pa.float64()), ("texto", pa.string()), ("unidad", pa.string())]
)


def _winners(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Rows sorted by entity and column, cut to the last numeric and the last
    text row of each cell; with the masks of those two kinds."""
    rows = rows.sort_by([("entidad", "ascending"), ("columna", "ascending"), ("fila", "ascending"), ("num", "ascending"), ("texto", "ascending")])
    entity, column = rows["entidad"].to_numpy(), rows["columna"].to_numpy()
    keep = []
    for name in ("num", "texto"):
        valid = np.flatnonzero(pc.is_valid(rows[name]).to_numpy())
        e, c = entity[valid], column[valid]
        last = np.ones(len(valid), bool)
        last[:-1] = (e[1:] != e[:-1]) | (c[1:] != c[:-1])
        mask = np.zeros(rows.num_rows, bool)
        mask[valid[last]] = True
        keep.append(mask)
    either = keep[0] | keep[1]
    return rows.filter(pa.array(either)), keep[0][either], keep[1][either]


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield from _winners(pa.Table.from_batches([batch]).cast(_LAST))[0].combine_chunks().to_batches()


def _build(names: list[str], cells: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def wide(rows: pa.Table) -> pa.RecordBatch:
        rows, numeric, textual = _winners(rows)
        entity, column = rows["entidad"].to_numpy(), rows["columna"].to_numpy()
        starts = np.flatnonzero(np.r_[True, entity[1:] != entity[:-1]])
        slot = np.cumsum(np.r_[False, entity[1:] != entity[:-1]])
        arrays, labels = [pa.array(entity[starts])], ["entidad"]
        size = len(starts)
        for j, name in enumerate(names):
            here = column == j
            for cell in cells:
                source, mask = {
                    "valor": ("num", numeric), "unidad": ("unidad", numeric),
                    "fila": ("fila", numeric), "texto": ("texto", textual),
                }[cell]
                at = np.flatnonzero(here & mask)
                take = np.full(size, -1)
                take[slot[at]] = at
                index = pa.array(np.maximum(take, 0), mask=take < 0)
                arrays.append(rows[source].combine_chunks().take(index))
                labels.append(name if cell == "valor" else f"{name}_{cell}")
        return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows = _LAST.empty_table()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.concat_tables([open_rows, pa.Table.from_batches([batch]).cast(_LAST)])
            entity = rows["entidad"].to_numpy()
            cut = int(np.searchsorted(entity, entity[-1], "left"))  # sorted input: the last entity may go on
            if cut:
                yield wide(rows.slice(0, cut))
            open_rows = _winners(rows.slice(cut))[0]
        if open_rows.num_rows:
            yield wide(open_rows)

    return run


def to_wide(rows: DataFrame, names: list[str], cells: tuple[str, ...] = ("valor", "unidad", "fila", "texto")) -> DataFrame:
    """``rows`` (entidad, columna, fila, num, texto, unidad) to one row per entidad.

    ``columna`` is an index into ``names``. For each name and kind in ``cells``
    there is one column: ``NAME`` (double), ``NAME_unidad`` (string, of the
    number), ``NAME_fila`` (long, row id of the number), ``NAME_texto`` (string).
    """
    ship(rows.sparkSession)
    kinds = {"valor": "double", "unidad": "string", "fila": "bigint", "texto": "string"}
    schema = ["entidad bigint"] + [
        f"`{n}` double" if c == "valor" else f"`{n}_{c}` {kinds[c]}" for n in names for c in cells
    ]
    reduced = rows.select(*[c.split()[0] for c in _LONG.split(", ")]).mapInArrow(_combine, _LONG)
    ordered = reduced.repartition("entidad").sortWithinPartitions("entidad", "columna", "fila")
    return ordered.mapInArrow(_build(names, cells), ", ".join(schema))


def laboratory_rows(results: DataFrame, ref: DataFrame) -> tuple[DataFrame, list[str]]:
    """Encoded rows of ``resultado_laboratorio`` and the column names in order.

    Spellings repeat endlessly: their keys are made once per distinct (name,
    section), a row only carries its column index.
    """
    ref = ref.where(F.col("ambito") == "laboratorio")
    names = attribute_names(ref)
    codes = results.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "codigo string, columna int")
    keys = bounded(analyte_names(ref)).select("seccion_key", "nombre_key", "codigo")
    full = keys.withColumnRenamed("codigo", "c1")
    base = keys.select("seccion_key", F.col("nombre_key").alias("base_key"), F.col("codigo").alias("c2"))
    filled = results.where(
        F.col("id_estudio").isNotNull() & (F.col("valor_num").isNotNull() | F.col("valor_texto").isNotNull())
    )
    spelled = filled.select("analito", "seccion").where("analito IS NOT NULL AND seccion IS NOT NULL").distinct()
    spelled = (
        spelled.withColumn("seccion_key", section_key(F.col("seccion")))
        .withColumn("nombre_key", name_key(F.col("analito")))
        .withColumn("base_key", name_key(name_base(F.col("analito"))))
        .join(full, ["seccion_key", "nombre_key"], "left")
        .join(base, ["seccion_key", "base_key"], "left")
        .withColumn("codigo", F.coalesce("c1", "c2"))
        .join(F.broadcast(codes), "codigo")
        .select("analito", "seccion", "columna")
    )
    rows = filled.join(lookup(spelled), ["analito", "seccion"]).select(
        F.col("id_estudio").cast("long").alias("entidad"),
        "columna",
        F.col("id_resultado").cast("long").alias("fila"),
        F.col("valor_num").cast("double").alias("num"),
        F.col("valor_texto").alias("texto"),
        F.col("unidad").alias("unidad"),
    )
    return rows, names


def attribute_names(ref: DataFrame) -> list[str]:
    """The codes of the attribute table in order: they fix the schema of the result.

    At most ``MAX_COLUMNS`` come to the driver; more attributes than a table can
    have columns are an error, not a cut.
    """
    found = ref.select("codigo").where("codigo IS NOT NULL").distinct().limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} attributes: no wide table")
    return sorted(r[0] for r in found)


def laboratory_wide(results: DataFrame, ref: DataFrame, cells: tuple[str, ...] = ("valor", "unidad", "fila", "texto")) -> DataFrame:
    """One row per ``id_estudio`` with typed columns per laboratory code."""
    rows, names = laboratory_rows(results, ref)
    wide = to_wide(rows, names, cells)
    return wide.withColumn("entidad", F.col("entidad").cast("int")).withColumnRenamed("entidad", "id_estudio")


def filled_numeric_cells(wide: DataFrame) -> DataFrame:
    """id_estudio, codigo, id_resultado: the filled numeric cells of the wide table."""
    names = [c[: -len("_fila")] for c in wide.columns if c.endswith("_fila")]
    cells = F.array(*[F.struct(F.lit(n).alias("codigo"), F.col(f"{n}_fila").alias("id_resultado")) for n in names])
    return wide.select("id_estudio", F.inline(F.filter(cells, lambda x: x["id_resultado"].isNotNull())))

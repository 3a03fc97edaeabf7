"""Idempotent appends, echo pivot, export assembly and manifest."""

from __future__ import annotations

import json
import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Extras that name people.
PERSONAL_KEYS = ["medico_derivante", "medico_solicitante", "tecnico"]
#: Echo labels with a column of their own.
ECHO_COLUMNS = {
    "AO": "ao", "AI": "ai", "DDVI": "ddvi", "DSVI": "dsvi", "FA": "fa", "SEPTUM": "septum",
    "P. POSTERIOR": "p_posterior", "P.POSTERIOR": "p_posterior",
}


def append_new(new: DataFrame, existing: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of ``new`` to insert: one per key that ``existing`` lacks; null keys always."""
    keyed = new.where(F.col(key).isNotNull())
    one = keyed.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
    return one.join(existing.select(key).distinct(), key, "left_anti").select(*new.columns).unionByName(
        new.where(F.col(key).isNull())
    )


def new_episodes(linked: DataFrame, existing: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct episodes that are not stored yet."""
    return linked.select(*columns).distinct().join(existing.select(key), key, "left_anti")


def echo_wide(measures: DataFrame, doc: str, name: str, value: str, unit: str, order: str) -> DataFrame:
    """One row per study: seven known measures, their units and the other measures.

    The last of repeated labels wins. Measures of one study are few by nature;
    they are reduced with ``max_by`` and map-side combine, never sorted as a group.
    """
    label = F.upper(F.trim(F.col(name)))
    column = F.lit(None).cast("string")
    for k, v in ECHO_COLUMNS.items():
        column = F.when(label == k, F.lit(v)).otherwise(column)
    rows = measures.where(F.col(doc).isNotNull() & F.col(name).isNotNull()).select(
        doc, label.alias("_l"), column.alias("_c"), F.col(value).alias("_v"), F.col(unit).alias("_u"), F.col(order).alias("_o")
    )
    last = rows.groupBy(doc, F.coalesce("_c", "_l").alias("_k"), F.col("_c").isNotNull().alias("_known")).agg(
        F.max_by(F.struct("_v", "_u"), "_o").alias("_x")
    )
    fixed = list(dict.fromkeys(ECHO_COLUMNS.values()))
    picks = [F.max(F.when(F.col("_known") & (F.col("_k") == c), F.col("_x._v"))).alias(c) for c in fixed]
    pairs = lambda keep, v: F.map_from_entries(
        F.array_sort(F.collect_list(F.when(keep & v.isNotNull(), F.struct(F.col("_k"), v))))
    )
    out = last.groupBy(doc).agg(
        *picks,
        pairs(F.col("_known"), F.col("_x._u")).alias("unidades"),
        pairs(~F.col("_known"), F.col("_x._v")).alias("adicionales"),
    )
    empty = lambda c: F.when(F.size(c) > 0, F.col(c))
    return out.withColumns({"unidades": empty("unidades"), "adicionales": empty("adicionales")})


def without_personal(extras: Column) -> Column:
    """Extras without entries that name people."""
    return F.map_filter(extras, lambda k, v: ~k.isin(PERSONAL_KEYS))


def page_after(df: DataFrame, key: str, last: object | None, size: int) -> DataFrame:
    """Keyset page: the next ``size`` rows in key order after ``last``."""
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(size)


#: Rows of one exported part file at most, so that a part can be hashed whole.
ROWS_PER_FILE = 2_000_000


def export(
    tables: dict[str, DataFrame], whitelist: dict[str, list[str]], folder: str, manifest: dict, rows_per_file: int = ROWS_PER_FILE
) -> dict:
    """Write whitelisted tables as Parquet and publish them at once.

    Every run writes into a folder of its own. The manifest names that folder, with
    row counts and one SHA-256 per part file, computed on the executors; it is
    written under another name and renamed last. Until then readers see the run
    before, and a run that fails leaves it untouched. Of earlier runs the last one
    is kept for readers that have opened it.
    """
    unknown = set(tables) ^ set(whitelist)
    if unknown:
        raise ValueError(f"tables without a whitelist or the reverse: {sorted(unknown)}")
    spark = next(iter(tables.values())).sparkSession
    run = f"run-{uuid.uuid4().hex}"
    before = (_manifest(spark, folder) or {}).get("carpeta")
    manifest = manifest | {"carpeta": run, "tablas": {}}
    for name, df in tables.items():
        path = posixpath.join(folder, run, name)
        df.select(*whitelist[name]).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
        parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        hashes = parts.select(F.substring_index("path", "/", -1).alias("f"), F.sha2("content", 256).alias("h")).orderBy("f")
        manifest["tablas"][name] = {
            "filas": spark.read.parquet(path).count(),
            "columnas": [[c, t] for c, t in df.select(*whitelist[name]).dtypes],
            "archivos": {r["f"]: r["h"] for r in hashes.toLocalIterator()},
        }
    files, at = _file_system(spark, folder)
    text = json.dumps(manifest, ensure_ascii=False, indent=1, sort_keys=True)
    stream = files.create(at(".manifest.json.tmp"), True)
    stream.write(bytearray(text.encode()))
    stream.close()
    _rename(spark, at(".manifest.json.tmp"), at("manifest.json"))
    for status in files.listStatus(at("")):
        name = status.getPath().getName()
        if name.startswith("run-") and name not in (run, before):
            files.delete(status.getPath(), True)
    return manifest


def exported(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the published run; an error where nothing has been published."""
    manifest = _manifest(spark, folder)
    if manifest is None:
        raise FileNotFoundError(f"no manifest in {folder}")
    return {name: spark.read.parquet(posixpath.join(folder, manifest["carpeta"], name)) for name in manifest["tablas"]}


def _file_system(spark: SparkSession, folder: str):
    """The folder's Hadoop file system, and a function from names to its paths."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda name: jvm.org.apache.hadoop.fs.Path(posixpath.join(folder, name) if name else folder)
    return at("").getFileSystem(conf), at


def _rename(spark: SparkSession, source, target) -> None:
    """Replace ``target`` by ``source`` in one step."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(source), files.makeQualified(target), how)


def _manifest(spark: SparkSession, folder: str) -> dict | None:
    """The manifest of the published run, if there is one."""
    files, at = _file_system(spark, folder)
    if not files.exists(at("manifest.json")):
        return None
    rows = spark.read.text(posixpath.join(folder, "manifest.json"), wholetext=True).collect()  # one small file
    return json.loads(rows[0][0])


def backfill(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """``target`` with nulls of ``column`` filled from ``source``."""
    found = source.groupBy(key).agg(F.min(column).alias("_fill"))
    return target.join(found, key, "left").withColumn(column, F.coalesce(column, "_fill")).drop("_fill")


def payload(name: str, *columns: Column) -> Column:
    """Columns as one JSON payload, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(name)


def jdbc_options(url: str, table: str, partition: str | None = None, bounds: tuple[int, int, int] | None = None) -> dict[str, str]:
    """Options of a partitioned relational read or a batched write."""
    options = {
        "url": url, "dbtable": table, "batchsize": "1000", "fetchsize": "1000", "queryTimeout": "300",
        "isolationLevel": "READ_COMMITTED", "connectTimeout": "5",
    }
    if partition and bounds:
        low, high, count = bounds
        options |= {"partitionColumn": partition, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(count)}
    return options


def ensure_table(df: DataFrame, name: str, partition: list[str] | None = None) -> None:
    """Create an empty table of this schema if there is none; never touches an existing one."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        writer = df.limit(0).write.format("parquet")
        (writer.partitionBy(*partition) if partition else writer).saveAsTable(name)

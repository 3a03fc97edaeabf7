"""Session construction, shared checkpoint folder and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 200_000
#: And, where its content passes the driver, at most this many bytes.
BROADCAST_BYTES = 64 << 20


def local_session(app: str = "cordal", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CORDAL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for written stages: the one ``spark.checkpoint.dir`` names.

    Only when neither the session nor the context names one (tests on one machine)
    is a folder of our own set; a cluster without one is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cordal-checkpoint-"))
        named = sc.getCheckpointDir()
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage: ``df`` written as a table in the shared folder and read back.

    Unlike an RDD checkpoint this computes the last stage once, and the plans
    behind it know the size of the table. The application's tables go when it ends.
    """
    spark = df.sparkSession
    jvm, folder = spark.sparkContext._jvm, f"{shared_folder(spark)}/cordal-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
        _FOLDERS.add(folder)
    table = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(table)
    return spark.read.schema(df.schema).parquet(table)


_FOLDERS: set[str] = set()


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else unchanged.

    The count stops after ``rows + 1`` rows, so the check itself is bounded. For
    tables that are read, not derived; see ``lookup``.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lookup(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Like ``bounded`` for a table derived from a large one, bounded in rows and bytes.

    The derivation runs once: at most ``rows + 1`` rows come back as Arrow and
    become a local relation. Nothing stays cached. A larger table is joined as it is.
    """
    found = df.limit(rows + 1).toArrow()
    if found.num_rows > rows or found.nbytes > BROADCAST_BYTES:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    The sources are zipped on the driver and served to the executors by Spark, so
    no installation and no path on the executors is needed.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="cordal-")) / "cordal.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (a file or a folder of that name)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

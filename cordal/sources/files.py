"""File scans: listed artifacts with content hashes, text-page documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cordal.operators import dedup

_PAGE = r"(?m)^## pagina (\d+) \(orden (de dibujado|geometrico)\)[ \t]*\r?\n"


def scan(spark: SparkSession, root: str, extensions: list[str], cap: int = dedup.MAX_BYTES) -> DataFrame:
    """path, length, grupo, codigo, huella of the files below ``root``.

    Size and format are decided on the listing alone. Only accepted files are
    opened: a second scan has the size limit and the suffixes as pushed filters.
    """
    read = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True)
    clean = F.regexp_replace("path", "^file:/+", "/")
    base = root.split("://", 1)[-1].rstrip("/") + "/"
    group = dedup.folder_group(F.regexp_replace(clean, "^.*?" + "\\Q" + base + "\\E", ""))
    rejected = dedup.route(read().load(root).select("path", "modificationTime", "length"), extensions, cap).where("codigo IS NOT NULL")
    any_case = ["*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in extensions]
    small = read().option("pathGlobFilter", "{" + ",".join(any_case) + "}").load(root).where(F.col("length") <= cap)
    accepted = dedup.route(small.withColumn("huella", F.sha2("content", 256)).drop("content"), extensions, cap).where("codigo IS NULL")
    return accepted.unionByName(rejected, allowMissingColumns=True).withColumn("grupo", group)


def verified(files: DataFrame, content: str, sha: str) -> DataFrame:
    """Rows whose content still has the recorded hash; another hash is an error."""
    same = F.sha2(content, 256) == F.col(sha)
    return files.where(F.assert_true(same, F.lit("content does not match its recorded hash")).isNull())


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """documento, paginas (drawing order), paginas_orden (position order) of text-page files.

    Each file holds ``## pagina N (orden …)`` blocks; comment lines before the
    first block are skipped. A document without any text has empty pages (S05).
    """
    raw = spark.read.text(path, wholetext=True).withColumn("documento", F.col("_metadata.file_name"))
    body = F.regexp_replace("value", r"\r\n?", "\n")
    marks = F.regexp_extract_all(body, F.lit(_PAGE.replace(r"\r?", "")), F.lit(2))
    pieces = F.split(body, _PAGE.replace(r"\r?", ""))
    blocks = F.slice(pieces, F.lit(2), F.size(pieces))
    paired = F.arrays_zip(marks.alias("orden"), blocks.alias("texto"))
    pick = lambda order: F.transform(F.filter(F.col("p"), lambda x: x["orden"] == order), lambda x: F.regexp_replace(x["texto"], r"\s+$", ""))
    return raw.withColumn("p", paired).select(
        "documento", pick("de dibujado").alias("paginas"), pick("geometrico").alias("paginas_orden")
    )


def readable(pages: DataFrame, column: str = "paginas") -> DataFrame:
    """``pages`` with ``codigo``: no page is unreadable, pages without text lack a text layer."""
    text = F.array_join(column, "\n")
    return pages.withColumn(
        "codigo", F.when(F.size(column) == 0, "pdf_ilegible").when(F.trim(text) == "", "sin_capa_de_texto")
    )


def formatted_pages(pages: DataFrame, key: str = "documento", note: str = "") -> DataFrame:
    """(key, value): documents in the text-page format that ``text_pages`` reads."""

    def blocks(column: str, order: str):
        return F.transform(
            column, lambda t, i: F.concat(F.lit("## pagina "), (i + 1).cast("string"), F.lit(f" (orden {order})\n"), t, F.lit("\n"))
        )

    body = F.array_join(F.concat(blocks("paginas", "de dibujado"), blocks("paginas_orden", "geometrico")), "")
    return pages.select(key, F.concat(F.lit(f"# {note}\n" if note else ""), body).alias("value"))


def drawn_traces(pages: DataFrame, kind: str, drawings: str) -> DataFrame:
    """``pages`` with ``trazos``: strokes are taken from ECG documents only."""
    from cordal.operators.signals import STROKES, usable_strokes

    empty = F.lit(None).cast(STROKES)
    return pages.withColumn("trazos", F.when(F.col(kind) == "ecg", usable_strokes(F.col(drawings))).otherwise(empty))

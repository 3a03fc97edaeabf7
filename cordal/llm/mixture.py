"""Mixing sources to target weights: a fair schedule of token blocks.

Every source hands out blocks: one per document and repetition, the size of the
document in tokens. Block ``j`` of a source with target weight ``w`` and ``c``
tokens in its earlier blocks is released when the mix has reached ``c / w``
tokens and is due when it reaches ``(c + size) / w`` (Pfair release times and
deadlines). Serving the earliest deadline first interleaves the sources so that
at any point no source is more than about one block away from its share.

Without a stated ``total`` the mix grows until the first source with a weight has
used all its allowed repetitions, the others still having blocks: total = min over
sources of capacity / weight. Beyond it the target shares cannot be kept, so blocks
due later are not scheduled. A stated ``total`` is taken as it is: where it is more
than a source can give, that source ends early and the report shows by how much its
share falls short.

Distributed plan: token counts come from one scan in Python batches; the offset
of a document within its source is a two-level prefix sum (chunk totals, then a
running sum inside the chunk), so a source that holds a third of all rows is
never sorted in one task. Deadlines are then arithmetic per block, the global
order is a range-partitioned sort, and no row is collected. The tables of
sources and of chunk totals are small; the former is counted before broadcast.

Defined results
---------------
* null or empty text: zero tokens; it is not scheduled (it adds nothing).
* null or unknown source: not part of the mix; the report counts it as '(otra)'.
* spellings of a source differing in case, blanks and dashes are one source.
* ties in deadline: source name, then repetition, then document id.
* a source without documents: capacity 0; it is reported and left out of the
  limit, otherwise nothing could be mixed.
"""

from __future__ import annotations

import importlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cordal.session import bounded, checkpoint, ship

DEFAULT_TOKENIZER = "byte_bpe_50k.tiktoken"
CHUNK_ROWS = 4096


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """The file of a public tokenizer in the installed collection."""
    return str(importlib.import_module("public_tokenizers").path(name))


def source_key(text: Column) -> Column:
    """Lower case, no outer blanks, blanks and dashes as underscores."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(text, r"\s+", " "))), "[ -]+", "_")


_ENCODERS: dict[str, object] = {}


def _encoder(path: str, pattern: str):
    """The encoding of a rank file, made once per worker.

    Executors that do not have the file under its path take the one that
    ``token_counts`` has handed out.
    """
    if path not in _ENCODERS:
        import base64

        import tiktoken
        from pyspark import SparkFiles

        with open(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding("cordal", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, fuente (source key) and tokens of every document."""
    spark = documents.sparkSession
    ship(spark)
    spark.sparkContext.addFile(path)
    pattern = importlib.import_module("public_tokenizers").PATTERN

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(path, pattern).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if isinstance(t, str) else 0 for t in batch["text"]]
            yield batch[["doc_id", "fuente"]].assign(tokens=counts)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source")).alias("fuente"), "text")
    return rows.mapInPandas(run, "doc_id bigint, fuente string, tokens bigint")


def _prefix_sums(counts: DataFrame, chunk: int) -> DataFrame:
    """``antes``: tokens of the documents of the source that come before.

    The documents of a source fall by the hash of their id into chunks of about
    ``chunk`` rows, however the ids are spread; the order is chunk, then id. Only
    the chunk totals are summed in one window per source.
    """
    sizes = counts.groupBy("fuente").agg(F.ceil(F.count("*") / F.lit(chunk)).alias("trozos"))
    placed = counts.join(bounded(sizes), "fuente").withColumn("trozo", F.pmod(F.xxhash64("doc_id"), F.col("trozos")))
    totals = placed.groupBy("fuente", "trozo").agg(F.sum("tokens").alias("suma"))
    before = totals.withColumn(
        "base",
        F.coalesce(
            F.sum("suma").over(W.partitionBy("fuente").orderBy("trozo").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ),
    ).select("fuente", "trozo", "base")
    inside = W.partitionBy("fuente", "trozo").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.join(before, ["fuente", "trozo"])
        .withColumn("antes", F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .select("fuente", "doc_id", "tokens", "antes")
    )


def _sources(counts: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """Per source with a target: weight, repetitions, tokens, capacity and the total it allows."""
    have = counts.groupBy("fuente").agg(F.sum("tokens").alias("tokens_fuente"), F.count("*").alias("documentos"))
    rows = targets.select(
        source_key(F.col("source")).alias("fuente"),
        F.col("peso").cast("double").alias("peso"),
        F.col("max_repeticiones").cast("long").alias("repeticiones"),
    ).where("peso > 0")
    return (
        rows.join(have, "fuente", "left")
        .fillna(0, ["tokens_fuente", "documentos"])
        .withColumn("capacidad", F.col("tokens_fuente") * F.col("repeticiones"))
        .withColumn("permite", F.when(F.col("capacidad") > 0, F.col("capacidad") / F.col("peso")))
        .withColumn("total", F.min("permite").over(W.partitionBy(F.lit(1))) if total is None else F.lit(float(total)))
    )


def schedule(
    documents: DataFrame, targets: DataFrame, path: str | None = None, chunk: int = CHUNK_ROWS, total: float | None = None
) -> DataFrame:
    """doc_id, fuente, repeticion, tokens, liberado, vence: the blocks of the mix.

    ``vence`` is the deadline in tokens of the whole mix; ascending order of
    (vence, fuente, repeticion, doc_id) is the interleaving.
    """
    counts = checkpoint(token_counts(documents, path or tokenizer_path()).where("tokens > 0").dropDuplicates(["doc_id"]))
    return _blocks(counts, _sources(counts, targets, total), chunk)


def _blocks(counts: DataFrame, sources: DataFrame, chunk: int) -> DataFrame:
    listed = bounded(sources.select("fuente", "peso", "repeticiones", "tokens_fuente", "total"))
    wanted = counts.join(listed.select("fuente"), "fuente", "left_semi")
    rows = _prefix_sums(wanted, chunk).join(listed, "fuente")
    # only the repetitions whose first block can still be due within the mix
    rounds = F.least(F.col("repeticiones"), F.ceil(F.col("total") * F.col("peso") / F.col("tokens_fuente")).cast("long"))
    blocks = rows.withColumn("repeticion", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(rounds, F.lit(1)))))
    start = F.col("antes") + (F.col("repeticion") - 1) * F.col("tokens_fuente")
    return (
        blocks.withColumn("liberado", start / F.col("peso"))
        .withColumn("vence", (start + F.col("tokens")) / F.col("peso"))
        .where(F.col("vence") <= F.col("total") * (1 + 1e-12))
        .select("doc_id", "fuente", "repeticion", "tokens", "liberado", "vence")
    )


def in_order(blocks: DataFrame) -> DataFrame:
    """The blocks in the order of the mix (a range-partitioned global sort)."""
    return blocks.orderBy("vence", "fuente", "repeticion", "doc_id")


def share_report(
    documents: DataFrame, targets: DataFrame, path: str | None = None, chunk: int = CHUNK_ROWS, total: float | None = None
) -> DataFrame:
    """Per source: target weight, capacity, tokens used, share reached, deviation, repetitions used."""
    counts = checkpoint(token_counts(documents, path or tokenizer_path()).where("tokens > 0").dropDuplicates(["doc_id"]))
    sources = _sources(counts, targets, total)
    used = (
        _blocks(counts, sources, chunk)
        .groupBy("fuente")
        .agg(F.sum("tokens").alias("tokens_mezcla"), F.max("repeticion").alias("vueltas"), F.count("*").alias("bloques"))
    )
    whole = W.partitionBy(F.lit(1))
    report = sources.join(used, "fuente", "left").fillna(0, ["tokens_mezcla", "vueltas", "bloques"])
    report = report.withColumn("cuota", F.round(F.col("tokens_mezcla") / F.sum("tokens_mezcla").over(whole), 6))
    other = (
        counts.join(bounded(sources.select("fuente")), "fuente", "left_anti")
        .agg(F.sum("tokens").alias("tokens_fuente"), F.count("*").alias("documentos"))
        .where("documentos > 0")
        .select(F.lit("(otra)").alias("fuente"), "tokens_fuente", "documentos")
    )
    return report.select(
        "fuente", "peso", "repeticiones", "documentos", "tokens_fuente", "capacidad", "tokens_mezcla", "vueltas",
        "bloques", "cuota", F.round(F.col("cuota") - F.col("peso"), 6).alias("desvio"),
    ).unionByName(other, allowMissingColumns=True)

"""Leak audit: how often known literals occur in records.

The literals of an audit are a bounded set; they go to the executors as one
automaton in blocks, so records are scanned once and never joined literal by literal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordal.session import ship

BLOCK_LITERALS = 100_000


def count_leaks(records: DataFrame, key: str, text: str, literals: DataFrame, literal: str, block: int = BLOCK_LITERALS) -> DataFrame:
    """(key, coincidencias): present literals per record times their multiplicity.

    Case folded on both sides. An empty literal is in every record. Records
    without any are left out; null records hold nothing.
    """
    spark = records.sparkSession
    ship(spark)
    folded = literals.where(F.col(literal).isNotNull()).select(F.col(literal).alias("l"))
    blocks = max(1, -(-folded.count() // block))
    kind = records.schema[key].dataType.simpleString()
    source = records.where(F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("_t"))

    def search(part: int) -> DataFrame:
        rows = folded if blocks == 1 else folded.where(F.pmod(F.xxhash64("l"), F.lit(blocks)) == part)
        counted = rows.groupBy("l").count()
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in counted.collect()])  # one bounded block

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import ahocorasick

            times = Counter()
            for word, n in shared.value:
                times[word.casefold()] += n
            empty = times.pop("", 0)
            automaton = ahocorasick.Automaton()
            for word in times:
                automaton.add_word(word, word)
            if times:
                automaton.make_automaton()
            for batch in batches:
                found = []
                for record in batch["_t"]:
                    seen = {w for _, w in automaton.iter(record.casefold())} if times else set()
                    found.append(empty + sum(times[w] for w in seen))
                out = pd.DataFrame({key: batch[key], "coincidencias": found})
                yield out[out["coincidencias"] > 0]

        return source.mapInPandas(run, f"`{key}` {kind}, coincidencias bigint")

    parts = reduce(DataFrame.unionByName, [search(p) for p in range(blocks)])
    return parts if blocks == 1 else parts.groupBy(key).agg(F.sum("coincidencias").alias("coincidencias"))

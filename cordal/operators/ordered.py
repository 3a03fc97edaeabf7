"""Neighbours and running sums over an ordered key, without one task per key.

A key's rows are cut by ``slot``, a column that never falls in the given order
(a day, say). Windows run inside (key, slot); what crosses a border is one row
per slot, so a key with a third of all rows is spread over its slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_previous(df: DataFrame, key: str, order: list[str], value: str, slot: Column, name: str = "anterior") -> DataFrame:
    """``df`` with ``name`` (value of the row before) and ``_primera`` (no row before)."""
    rows = df.withColumn("_slot", slot)
    inside = W.partitionBy(key, "_slot").orderBy(*order)
    rows = rows.withColumn("_n", F.row_number().over(inside)).withColumn("_prev", F.lag(value).over(inside))
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order))
    borders = rows.groupBy(key, "_slot").agg(last.alias("_last"))
    before = F.lag("_last").over(W.partitionBy(key).orderBy("_slot"))
    borders = borders.select(F.col(key).alias("_key"), F.col("_slot").alias("_s"), before.alias("_before"))
    joined = rows.join(borders, rows[key].eqNullSafe(borders["_key"]) & rows["_slot"].eqNullSafe(borders["_s"]))
    first = F.col("_n") == 1
    return (
        joined.withColumn(name, F.when(first, F.col("_before.v")).otherwise(F.col("_prev")))
        .withColumn("_primera", first & F.col("_before").isNull())
        .drop("_n", "_prev", "_key", "_s", "_before")
    )


def maximum_before(df: DataFrame, key: str, order: list[str], value: str, slot: Column, name: str) -> DataFrame:
    """``df`` with ``_slot`` and the maximum of ``value`` over the rows before each row."""
    rows = df.withColumn("_slot", slot)
    inside = W.partitionBy(key, "_slot").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_local", F.max(value).over(inside))
    earlier = F.max("_m").over(W.partitionBy(key).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1))
    tops = df.withColumn("_slot", slot).groupBy(key, "_slot").agg(F.max(value).alias("_m"))
    tops = tops.select(F.col(key).alias("_key"), F.col("_slot").alias("_s"), earlier.alias("_base"))
    joined = rows.join(tops, rows[key].eqNullSafe(tops["_key"]) & rows["_slot"].eqNullSafe(tops["_s"]))
    return joined.withColumn(name, F.greatest("_local", "_base")).drop("_local", "_key", "_s", "_base")


def running_sum(df: DataFrame, key: str, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` up to each row; ``df`` must have ``_slot`` from a function above."""
    inside = W.partitionBy(key, "_slot").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = df.withColumn("_local", F.sum(value).over(inside))
    totals = df.groupBy(key, "_slot").agg(F.sum(value).alias("_t"))
    earlier = F.sum("_t").over(W.partitionBy(key).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select(F.col(key).alias("_key"), F.col("_slot").alias("_s"), F.coalesce(earlier, F.lit(0)).alias("_base"))
    joined = rows.join(totals, rows[key].eqNullSafe(totals["_key"]) & rows["_slot"].eqNullSafe(totals["_s"]))
    return joined.withColumn(name, F.col("_base") + F.col("_local")).drop("_key", "_s", "_base", "_local")

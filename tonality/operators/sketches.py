"""Mergeable sketches of long histories, stored as tables.

A day of a source is two small sketches, both kept as ordinary rows so that merging is
an aggregation:

* quantiles: counts in buckets of a geometric grid. Bucket b holds values in (g^(b-1), g^b], g = (1 + e) / (1 - e), so
  every quantile read from merged counts is within the relative error e of the exact order statistic, at any size;
* distinct values: 2^p registers, each the largest rank (leading zeros plus one) among the hashes that fall to it; the
  harmonic mean gives the count with a standard error of about 1.04 / sqrt(2^p), linear counting serves small ones.

Beside days the table holds blocks of 2, 4, 8, ... days, each made from the level below, so a range of D days
reads at most 2 log2(D) blocks a source and never the events.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.operators.similarity import materialize

ERROR = 0.01
P = 10  # 1,024 registers
GRID = (1 + ERROR) / (1 - ERROR)
COUNT, REGISTER = "q", "d"  # kinds of rows


def value_bucket(x: Column) -> Column:
    """Grid bucket of a value above zero; null else (see ``daily_sketches``)."""
    return F.when(x > 0, F.ceil(F.ln(x) / math.log(GRID)).cast("int"))


def bucket_value(b: Column) -> Column:
    """The value that is within the error of all values of a bucket."""
    return 2 * F.pow(F.lit(GRID), b) / (GRID + 1)


def register_of(value: Column) -> tuple[Column, Column]:
    """(register, rank) of a value's md5: 12 bits choose (``P`` are used), 52 bits are ranked."""
    h = F.md5(value.cast("string"))
    reg = F.shiftright(F.conv(F.substring(h, 1, 3), 16, 10).cast("int"), 12 - P)
    rest = F.conv(F.substring(h, 4, 13), 16, 10).cast("long")
    return reg, F.when(rest == 0, F.lit(53)).otherwise(53 - F.length(F.bin(rest))).cast("int")


def daily_sketches(events: DataFrame, source: str, time: str, value: str, distinct: str) -> DataFrame:
    """(level 0, block = day number, source, kind, slot, n): both sketches of every day, by partial aggregation.

    Values that are zero or less share the slot of the smallest int and read as 0; null values and null distinct values
    are in no sketch; rows with a null source or time are left out.
    """
    day = F.unix_date(F.col(time).cast("date")).cast("long")
    e = events.select(F.col(source).alias("source"), day.alias("block"), F.col(value).cast("double").alias("v"), F.col(distinct).alias("u")).where("source is not null and block is not null")
    zero = F.lit(-(1 << 31)).cast("int")
    counts = (e.where("v is not null and not isnan(v)").groupBy("source", "block", F.coalesce(value_bucket(F.col("v")), zero).alias("slot")).agg(F.count(F.lit(1)).alias("n")))
    reg, rank = register_of(F.col("u"))
    ranks = e.where("u is not null").groupBy("source", "block", reg.alias("slot")).agg(F.max(rank).cast("long").alias("n"))
    rows = counts.withColumn("kind", F.lit(COUNT)).unionByName(ranks.withColumn("kind", F.lit(REGISTER)))
    return rows.select(F.lit(0).alias("level"), "block", "source", "kind", "slot", "n")


def merged(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys, kind and slot as one: counts add up, registers take the largest."""
    return rows.groupBy(*keys, "kind", "slot").agg(F.when(F.col("kind") == COUNT, F.sum("n")).otherwise(F.max("n")).alias("n"))


def with_levels(daily: DataFrame, levels: int) -> DataFrame:
    """The daily rows and those of blocks of 2, 4, ... 2^levels days, each level from the one below."""
    out = level = materialize(daily)
    for j in range(1, levels + 1):
        up = level.withColumn("block", F.shiftright("block", 1))
        level = materialize(merged(up, "block", "source").select(F.lit(j).alias("level"), "block", "source", "kind", "slot", "n"))
        out = out.unionByName(level)
    return out


def blocks_of(first: int, last: int, levels: int) -> list[tuple[int, int]]:
    """(level, block) of the fewest stored blocks that make up the days ``first`` to ``last``."""
    out, at = [], first
    while at <= last:
        j = 0
        while j < levels and at % (2 << j) == 0 and at + (2 << j) - 1 <= last:
            j += 1
        out.append((j, at >> j))
        at += 1 << j
    return out


def read_range(sketches: DataFrame, first: int, last: int, levels: int, quantiles=(0.5, 0.9, 0.99)) -> DataFrame:
    """One row a source: ``n``, each quantile (``p50`` ...) and ``n_distinct`` over a range of days, from sketches alone.

    The quantile q is the value of 0-based rank ``floor(q * (n - 1))``.
    """
    wanted = F.lit(False)
    for level, block in blocks_of(first, last, levels):
        wanted = wanted | ((F.col("level") == level) & (F.col("block") == block))
    m = materialize(merged(sketches.where(wanted), "source"))
    # counts of one source: at most the grid's buckets, a few thousand rows
    c = m.where(F.col("kind") == COUNT).withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    c = c.withColumn("total", F.sum("n").over(Window.partitionBy("source")))
    value = F.when(F.col("slot") == -(1 << 31), F.lit(0.0)).otherwise(bucket_value(F.col("slot")))
    aggs = [F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("total") - 1)), value)).alias(f"p{round(100 * q)}") for q in quantiles]
    c = c.groupBy("source").agg(F.max("total").alias("n"), *aggs)
    regs = 1 << P
    d = m.where(F.col("kind") == REGISTER).groupBy("source").agg(F.count(F.lit(1)).alias("used"), F.sum(F.pow(F.lit(2.0), -F.col("n"))).alias("s"))
    alpha = 0.7213 / (1 + 1.079 / regs)
    raw = F.lit(alpha * regs * regs) / (F.col("s") + (regs - F.col("used")))
    small = (raw <= 2.5 * regs) & (F.col("used") < regs)
    d = d.select("source", F.round(F.when(small, regs * F.ln(regs / (regs - F.col("used")))).otherwise(raw)).cast("long").alias("n_distinct"))
    return c.join(d, "source", "full").select("source", F.coalesce("n", F.lit(0)).alias("n"), *[f"p{round(100 * q)}" for q in quantiles], F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))

"""Operators on ordered rows: maximal runs, attached totals, path numbers, open-row accumulation, systematic samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def maximal_runs(df: DataFrame, by: list[str], order: list[str], same: list[str], name: str = "block") -> DataFrame:
    """Number of the maximal run of equal values of same (nulls equal) that a row stands in, from 0."""
    w = Window.partitionBy(*by).orderBy(*order)
    prev = [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in same]
    change = F.when(F.row_number().over(w) == 1, 0).otherwise(reduce(lambda a, b: a | b, prev).cast("int"))
    return df.withColumn("_c", change).withColumn(name, F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_c")


def attach_to_open(df: DataFrame, by: list[str], order: list[str], opens: Column, key: str, name: str) -> DataFrame:
    """The key of the last opening row at or before each row: totals find the block they close."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(opens, F.col(key)), ignorenulls=True).over(w))


def restart_paths(df: DataFrame, by: list[str], order: list[str], value: str, name: str = "path_index") -> DataFrame:
    """Number of the path: a new one starts where the first value of the group comes again."""
    w = Window.partitionBy(*by).orderBy(*order)
    root = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_root", root).withColumn(name, (F.sum(F.col(value).eqNullSafe(F.col("_root")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int")).drop("_root")


def accumulate_open(df: DataFrame, by: list[str], order: list[str], closes: Column, name: str = "row_group") -> DataFrame:
    """Rows up to and including a closing row form one group: the number of closing rows before each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(closes.cast("int")).over(w), F.lit(0)).cast("int"))


def place_in_order(df: DataFrame, by: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """df with the place of each row in its stratum's order, from 0, and the strata's sizes.

    Counts per value of the first order column are summed up, then rows are numbered within each value, so that no window holds a whole stratum.
    """
    per = df.groupBy(*by, order[0]).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*by).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = per.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*by, order[0]])], (F.sum("_c").over(before) - F.col("_c")).alias("_before"))
    same = [df[c].eqNullSafe(starts[f"_k{i}"]) for i, c in enumerate([*by, order[0]])]
    inside = Window.partitionBy(*by, order[0]).orderBy(*(order[1:] or [order[0]]))
    out = df.join(starts, reduce(lambda a, b: a & b, same)).withColumn(name, F.col("_before") + F.row_number().over(inside) - 1)
    return out.drop("_before", *[f"_k{i}" for i in range(len(by) + 1)]), per.groupBy(*by).agg(F.sum("_c").alias("_n"))


def systematic_sample(df: DataFrame, by: list[str], order: list[str], every: int) -> DataFrame:
    """Every every-th row of each stratum in its order, and the quartile rows {0, n/4, n/2, 3n/4, n-1}; the reason tells which."""
    placed, sizes = place_in_order(df, by, order, "_i")
    sizes = sizes.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(by)], "_n")
    d = placed.join(sizes, reduce(lambda a, b: a & b, [placed[c].eqNullSafe(sizes[f"_s{i}"]) for i, c in enumerate(by)]))
    q = F.array(F.lit(0), F.floor(F.col("_n") / 4), F.floor(F.col("_n") / 2), F.floor(3 * F.col("_n") / 4), F.col("_n") - 1)
    quart = F.array_contains(q.cast("array<bigint>"), F.col("_i").cast("bigint"))
    step = F.col("_i") % every == 0
    return d.where(step | quart).withColumn("reason", F.when(step & quart, "BOTH").when(step, "STEP").otherwise("QUARTILE")).drop("_i", "_n", *[f"_s{i}" for i in range(len(by))])


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key in the order given; ties need a full order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_per(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Row of the greatest order per key, by one pre-aggregated pass."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_r")).select(*keys, "_r.*")

"""Declared against computed aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vwap(lines: DataFrame, by: list[str], price: Column, volume: Column, currency: Column) -> DataFrame:
    """(by, computed_volume, computed_vwap, currency): volume and volume-weighted price, the price only if all lines share one currency.

    Exact decimals; a line without price or volume makes both unknown; a volume of 0 gives no price.
    """
    p, v = price.cast("decimal(18,4)"), volume.cast("decimal(18,4)")
    whole = F.count_if(p.isNull() | v.isNull()) == 0
    one = F.countDistinct(currency) == 1
    total = F.sum(v)
    return lines.groupBy(*by).agg(
        F.when(whole, total).alias("computed_volume"), F.when(whole & one & (total != 0), (F.sum((p * v).cast("decimal(38,8)")).cast("double") / total.cast("double"))).alias("computed_vwap"), F.when(one, F.min(currency)).alias("currency"),
    )


def declared_qa(declared: Column, computed: Column, tolerance: Column) -> Column:
    """MATCH within the tolerance, DIVERGENT beyond, NO_DECLARED_AGGREGATE or NOT_COMPUTABLE where a side is missing."""
    return F.when(declared.isNull(), "NO_DECLARED_AGGREGATE").when(computed.isNull(), "NOT_COMPUTABLE").when(F.abs(declared - computed) <= tolerance, "MATCH").otherwise("DIVERGENT")


def flow_qa(rows: DataFrame, by: list[str], flag: str, amount: Column, declared: DataFrame, sides: dict[str, str]) -> DataFrame:
    """Sums of each side against the declared totals (absent ones count as 0), never netted: MATCH or DIVERGENT per side.

    sides: flag value -> column of declared, which has one row per by.
    """
    sums = rows.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col(flag) == k, amount)), F.lit(0)).alias(f"computed_{v}") for k, v in sides.items()])
    out = sums.join(declared.select(*by, *sides.values()), by, "left")
    return out.select(*by, *[f"computed_{v}" for v in sides.values()], *[F.when(F.coalesce(F.col(v), F.lit(0)) == F.col(f"computed_{v}"), "MATCH").otherwise("DIVERGENT").alias(f"qa_{v}") for v in sides.values()])


def position_qa(shares: Column, instruments: Column, total: Column, tolerance: Column) -> Column:
    """Whether shares and instruments add up to the declared total."""
    gap = F.abs(F.coalesce(shares, F.lit(0)) + F.coalesce(instruments, F.lit(0)) - total)
    return F.when(total.isNull() | (shares.isNull() & instruments.isNull()), "NOT_COMPUTABLE").when(gap <= tolerance, "DECLARED_COMPUTED_MATCH").otherwise("DECLARED_COMPUTED_MISMATCH")

"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import hashlib
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Expected copies are whole numbers of 1 / UNIT, so prefix sums are exact in any order of addition.
UNIT = 1 << 32


def plan_mix(available: dict[str, int], targets: list[tuple[str, float, int]], total_tokens: int | None = None) -> dict[str, dict]:
    """Expected copies per document of each source.

    Sources without tokens, without target or with a share of 0 give nothing; the shares of the others are scaled to sum to 1. total_tokens
    None: the largest total at which no source would need more than its max_repeats, so that every share is reached. Else sources whose share
    is out of reach at that total are used max_repeats times, and the report tells what they reach.
    """
    live = {s: (Fraction(w), int(m)) for s, w, m in targets if s is not None and w and w > 0 and m and m > 0 and available.get(s)}
    weight = sum((w for w, _ in live.values()), Fraction(0))
    if not live:
        return {}
    total = Fraction(total_tokens) if total_tokens is not None else min(available[s] * m * weight / w for s, (w, m) in live.items())
    return {s: {"expected": min(Fraction(m), total * w / weight / available[s]), "out_of_reach": total * w / weight > available[s] * m} for s, (w, m) in live.items()}


def _offset(source: str, seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:{source}".encode()).digest()[:4], "big") % UNIT


def mix(docs: DataFrame, targets: list[tuple[str, float, int]], *, doc_id: str, source: str, n_tokens: str, total_tokens: int | None = None, seed: int = 17, rows_per_bucket: int = 2_000_000) -> DataFrame:
    """The documents used, with their number of copies: (doc_id, source, n_tokens, copies).

    Within a source the documents stand in the order of (tokens, id); expected copies are summed up along it, one random
    offset a source is added, and a document is emitted once for every integer that its own interval of the sum crosses. The order by size makes the
    sample's tokens follow the source's. The prefix sums come from sums per hash bucket, length and band of lengths of a source, so that a hot source
    is never sorted or summed up in one task. A source of copies at most max_repeats stays so, as its expected copies don't exceed it.
    Null ids and sources are left out; repeated rows count once; documents without tokens are never used; no documents give no rows.
    """
    spark = docs.sparkSession
    names = [t[0] for t in targets if t[0] is not None]
    base = docs.where(F.col(doc_id).isNotNull() & F.col(source).isin(names) & (F.col(n_tokens) > 0)).groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(source).alias("source"), F.max(n_tokens).cast("bigint").alias("n_tokens"))
    sums = {r[0]: (int(r[1]), int(r[2])) for r in base.groupBy("source").agg(F.sum("n_tokens"), F.count(F.lit(1))).collect()}  # one row a target
    plan = plan_mix({s: t for s, (t, _) in sums.items()}, targets, total_tokens)
    if not plan:
        return base.select("doc_id", "source", "n_tokens", F.lit(0).cast("bigint").alias("copies")).limit(0)
    rows = [(s, int(p["expected"] * UNIT), _offset(s, seed)) for s, p in plan.items()]
    e = spark.createDataFrame([(s, str(x), str(o)) for s, x, o in rows], "source string, e string, off string").select("source", F.col("e").cast("decimal(20,0)").alias("e"), F.col("off").cast("decimal(38,0)").alias("off"))
    parts = max(1, -(-max(n for _, n in sums.values()) // rows_per_bucket))
    keyed = base.join(F.broadcast(e), "source").withColumn("_b", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    per = keyed.groupBy("source", "n_tokens", "_b").agg(F.sum("e").cast("decimal(38,0)").alias("_s"))
    # what stands in front of a bucket: sums over bands of lengths, over the lengths of its band, over the buckets of its length, so that no window holds more than one of these
    band = F.floor(F.log2("n_tokens") * 8).cast("int")
    lengths = per.groupBy("source", "n_tokens").agg(F.sum("_s").cast("decimal(38,0)").alias("_s")).withColumn("_band", band)
    bands = lengths.groupBy("source", "_band").agg(F.sum("_s").cast("decimal(38,0)").alias("_s"))

    def in_front(df: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(*by, order, (F.sum("_s").over(w) - F.col("_s")).cast("decimal(38,0)").alias(name))

    of_length = in_front(lengths, ["source", "_band"], "n_tokens", "_in_band").join(in_front(bands, ["source"], "_band", "_bands"), ["source", "_band"])
    starts = in_front(per, ["source", "n_tokens"], "_b", "_in_length").join(of_length, ["source", "n_tokens"]).select("source", "n_tokens", "_b", (F.col("_bands") + F.col("_in_band") + F.col("_in_length")).cast("decimal(38,0)").alias("_start"))
    inner = Window.partitionBy("source", "n_tokens", "_b").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = (F.col("_start") + F.sum("e").over(inner) + F.col("off")).cast("decimal(38,0)")
    out = keyed.join(starts, ["source", "n_tokens", "_b"]).withColumn("_end", end).withColumn("_from", (F.col("_end") - F.col("e")).cast("decimal(38,0)"))
    crossed = F.floor(F.expr(f"_end div {UNIT}")) - F.floor(F.expr(f"_from div {UNIT}"))
    return out.select("doc_id", "source", "n_tokens", crossed.cast("bigint").alias("copies")).where("copies > 0")


def shares(selection: DataFrame, available: DataFrame, targets: list[tuple[str, float, int]], *, source: str, n_tokens: str) -> DataFrame:
    """Per target: its share as asked and as reached, tokens and documents available and used. A target without source is left out, a null share or cap is 0."""
    spark: SparkSession = selection.sparkSession
    asked = spark.createDataFrame([(s, float(w or 0), int(m or 0)) for s, w, m in targets if s is not None], "source string, target_share double, max_repeats int")
    have = available.where(F.col(source).isin([t[0] for t in targets if t[0] is not None])).groupBy(F.col(source).alias("source")).agg(F.sum(F.col(n_tokens).cast("bigint")).alias("available_tokens"), F.count(F.lit(1)).alias("available_docs"))
    used = selection.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("used_tokens"), F.count(F.lit(1)).alias("used_docs"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    # both sides have at most one row a target
    rows = asked.join(F.broadcast(have), "source", "left").join(F.broadcast(used), "source", "left").na.fill(0)
    total = F.sum("used_tokens").over(Window.partitionBy())
    return rows.withColumn("actual_share", F.when(total > 0, F.col("used_tokens") / total).otherwise(0.0))

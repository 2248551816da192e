"""Per-period aggregates by event time, corrected by late records up to a cut-off, as retractions and insertions."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import broadcast_checked, drop_path, read_pointer, read_tables, scratch, swap_pointer

DAY_US = 86_400_000_000


def day_of(instant: Column | str) -> Column:
    """Day in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / DAY_US).cast("int"))


class LateAggregates:
    """Aggregates per (group, period) in a versioned keyed state, corrected by retractions and insertions.

    process(batch, upto) takes the rows that arrived since the last batch and before the instant upto. They are pre-aggregated per (group, period, arrival day),
    so a hot period shrinks to its days, and merged with the state of their periods:

    * before publication (publish_days after the period's end) rows only add up; version 0 is emitted once upto has passed the publication;
    * between publication and cut-off every day with rows makes one version more: a row of sign -1 takes the old aggregates back, one of sign +1 brings the new ones;
    * from the cut-off (cutoff_days after the end) on rows are refused: a row of sign 0 tells how many, the state stays.

    Deltas and new state are written first and become visible together by one pointer swap; a batch that fails before it is simply done again, one whose upto isn't
    after the committed one is not applied again. The sum of sign * aggregate up to a version is the aggregate as published then.

    measures: names of numeric columns to be summed, null counting as 0. Rows with a null period or arrival take no part; empty batches publish what has become due.
    Deltas: (group, period, version, known_on, sign, n_rows, measures); known_on is null for version 0, version is null for refusals.
    """

    def __init__(self, spark: SparkSession, measures: dict[str, str], group: dict[str, str] | None = None, *, publish_days: int = 10, cutoff_days: int = 60, folder: str | None = None):
        self.spark, self.measures, self.group = spark, measures, group or {}
        self.publish_days, self.cutoff_days = publish_days, cutoff_days
        self.folder = folder or scratch(spark, "late-state")
        keys = "".join(f"`{g}` {t}, " for g, t in self.group.items()) + "period date, "
        sums = "n_rows bigint" + "".join(f", `{m}` {t}" for m, t in measures.items())
        self.state_schema = f"{keys}version int, published boolean, {sums}"
        self.delta_schema = f"{keys}version int, known_on date, sign int, {sums}"

    def _committed(self) -> dict:
        return json.loads(read_pointer(self.spark, self.folder) or '{"upto": null, "commits": []}')

    def state(self) -> DataFrame:
        """Aggregates of every period as they stand, unpublished ones included."""
        return read_tables(self.spark, [f"{self.folder}/{c}/state" for c in self._committed()["commits"][-1:]], self.state_schema)

    def deltas(self) -> DataFrame:
        """The stream of all committed deltas."""
        return read_tables(self.spark, [f"{self.folder}/{c}/deltas" for c in self._committed()["commits"]], self.delta_schema)

    def process(self, rows: DataFrame, *, arrival: str, upto: int | None) -> None:
        """Merge the rows (period, arrival, group, measures) that arrived before upto, in microseconds since the epoch; None: all, every period becomes due."""
        told, spark = self._committed(), self.spark
        done, end = told["upto"], 1 << 62 if upto is None else upto
        if done is not None and end <= done:
            return
        by, names = [*self.group, "period"], ["n_rows", *self.measures]
        at = F.unix_micros(arrival)
        new = rows.where(F.col("period").isNotNull() & at.isNotNull() & (at < end) & (F.lit(True) if done is None else at >= done))
        per_day = new.groupBy(*by, day_of(arrival).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(m), F.lit(0)).cast(t).alias(m) for m, t in self.measures.items()])
        published_at, closed_at = (F.date_add(F.add_months(F.trunc("period", "month"), 1), n) for n in (self.publish_days, self.cutoff_days))
        days = F.array_sort(F.collect_list(F.struct("day", *names)))
        late, refused = (F.filter("_days", lambda d: cond(d)) for cond in (lambda d: (d["day"] >= published_at) & (d["day"] < closed_at), lambda d: d["day"] >= closed_at))
        early = F.filter("_days", lambda d: d["day"] < published_at)
        total = lambda days, m, start, t: F.aggregate(days, start.cast(t), lambda a, d: (a + d[m]).cast(t))
        types = {"n_rows": "bigint", **self.measures}
        old = self.state().select(*by, "version", "published", *[F.col(m).alias(f"_o_{m}") for m in names])
        base = per_day.groupBy(*by).agg(days.alias("_days")).join(old, by, "full_outer").withColumns({"version": F.coalesce("version", F.lit(0)), "published": F.coalesce("published", F.lit(False)), "_days": F.coalesce("_days", F.array().cast(per_day_type(names, types)))})
        # what is published before any correction of this batch
        base = base.withColumns({f"_v_{m}": total(early, m, F.coalesce(f"_o_{m}", F.lit(0)), types[m]) for m in names}).withColumns({"_late": late, "_refused": refused})
        due = ~F.col("published") & (F.col("_v_n_rows") > 0) & (F.unix_date(published_at).cast("bigint") * DAY_US <= end)
        delta = lambda version, known, sign, value: F.struct(version.cast("int").alias("version"), known.cast("date").alias("known_on"), F.lit(sign).alias("sign"), *[value(m).cast(types[m]).alias(m) for m in names])
        null = F.lit(None)
        first = F.when(due, F.array(delta(F.lit(0), null, 1, lambda m: F.col(f"_v_{m}")))).otherwise(F.array())
        before = lambda m, i: total(F.slice("_late", F.lit(1), i), m, F.col(f"_v_{m}"), types[m])
        corrections = F.flatten(F.transform("_late", lambda d, i: F.array(
            delta(F.col("version") + i + 1, d["day"], -1, lambda m: before(m, i)), delta(F.col("version") + i + 1, d["day"], 1, lambda m: before(m, i + 1)),
        )))
        refusals = F.transform("_refused", lambda d: delta(null, d["day"], 0, lambda m: d[m]))
        # a period that had nothing when its first correction came has nothing to take back
        out = base.select(*by, F.filter(F.concat(first, corrections, refusals), lambda x: (x["sign"] != -1) | (x["n_rows"] > 0)).alias("_deltas"), (F.col("version") + F.size("_late")).alias("version"), (F.col("published") | due | (F.size("_late") > 0)).alias("published"), *[before(m, F.size("_late")).cast(types[m]).alias(m) for m in names])
        commit = f"c-{uuid.uuid4().hex}"
        out.write.parquet(f"{self.folder}/{commit}/merged")
        merged = spark.read.parquet(f"{self.folder}/{commit}/merged")
        merged.select(*by, F.explode("_deltas").alias("_d")).select(*by, "_d.*").write.parquet(f"{self.folder}/{commit}/deltas")
        merged.drop("_deltas").where("n_rows > 0").write.parquet(f"{self.folder}/{commit}/state")
        drop_path(spark, f"{self.folder}/{commit}/merged")
        swap_pointer(spark, self.folder, json.dumps({"upto": end, "commits": [*told["commits"], commit]}))
        if told["commits"]:
            drop_path(spark, f"{self.folder}/{told['commits'][-1]}/state")


def per_day_type(names: list[str], types: dict[str, str]) -> str:
    return "array<struct<day:date," + ",".join(f"`{n}`:{types[n]}" for n in names) + ">>"


def arrivals_by_effect(rows: DataFrame, deltas: DataFrame, *, arrival: str) -> DataFrame:
    """rows that are not on time, with outcome CORRECTS or DROPPED: each finds what its (period, arrival day) did in the delta stream.

    Publication and cut-off begin at midnight UTC, so all rows of a period and day have the same effect. There is one line per period and day.
    """
    effect = deltas.where("known_on is not null").select("period", F.col("known_on").alias("_day"), F.when(F.col("sign") == 0, "DROPPED").otherwise("CORRECTS").alias("outcome")).distinct()
    return rows.withColumn("_day", day_of(arrival)).join(broadcast_checked(effect), ["period", "_day"]).drop("_day")


def roll_up_deltas(deltas: DataFrame, *, to: Column, name: str, measures: list[str]) -> DataFrame:
    """Downstream aggregate kept from deltas alone: per coarser period and day the signed change and the running total."""
    per_day = deltas.where("sign <> 0").groupBy(to.alias(name), "known_on").agg(*[F.sum(F.col("sign") * F.col(m)).alias(f"delta_{m}") for m in measures])
    run = Window.partitionBy(name).orderBy(F.col("known_on").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select("*", *[F.sum(f"delta_{m}").over(run).alias(f"total_{m}") for m in measures])

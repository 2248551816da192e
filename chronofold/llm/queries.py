"""The queries of the operators on names and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize, table
from . import encoding, mixing, names, packing, tokens


def _counted(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "documents").select(*columns, tokens.token_count("text").alias("n_tokens"))


def declarant_names(spark: SparkSession, d: str) -> DataFrame:
    """Distinct spellings of notice and notice_event, made distinct before they are shuffled."""
    return table(spark, d, "notice").select(F.col("declarant_name_raw").alias("name")).union(table(spark, d, "notice_event").select("declarant_name_raw")).where("name is not null").distinct()


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with its declarant."""
    return names.link_variants(declarant_names(spark, d))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variant_pairs(materialize(p1_entities(spark, d), "names-entities"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document (or piece of an over-long one) for each capacity of pack_budget."""
    budgets = [(r[0], r[1]) for r in table(spark, d, "pack_budget").select("budget_name", "capacity_tokens").distinct().collect()]
    return packing.pack(_counted(spark, d, "doc_id"), budgets, doc_id="doc_id", n_tokens="n_tokens", n_docs=table(spark, d, "documents").count())


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and share of used room per capacity."""
    budgets = table(spark, d, "pack_budget").distinct()
    per = p8_containers(spark, d).groupBy("budget_name").agg(F.countDistinct("container").alias("containers"), F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
    return per.join(F.broadcast(budgets), "budget_name").select("budget_name", "containers", "tokens", "pieces", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("used_room"))


def _targets(spark: SparkSession, d: str) -> list[tuple[str, float, int]]:
    return [(r[0], r[1], r[2]) for r in table(spark, d, "mix_target").select("source", "target_share", "max_repeats").distinct().collect()]


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mix with their copies."""
    docs = materialize(_counted(spark, d, "doc_id", "source"), "token-counts")
    return mixing.mix(docs, _targets(spark, d), doc_id="doc_id", source="source", n_tokens="n_tokens")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached shares of the mix."""
    docs = materialize(_counted(spark, d, "doc_id", "source").distinct(), "token-counts")
    t = _targets(spark, d)
    return mixing.shares(mixing.mix(docs, t, doc_id="doc_id", source="source", n_tokens="n_tokens"), docs, t, source="source", n_tokens="n_tokens")


def _budget(spark: SparkSession, docs: DataFrame, targets: list[tuple[str, float, int]]) -> int:
    """All tokens of targeted sources: a mix of that size leaves small sources behind their share."""
    return docs.where(F.col("source").isin([s for s, *_ in targets if s is not None])).agg(F.sum(F.col("n_tokens").cast("bigint"))).first()[0] or 0


def _whole_mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list[tuple[str, float, int]]]:
    docs, t = materialize(_counted(spark, d, "doc_id", "source").distinct(), "token-counts"), _targets(spark, d)
    return mixing.mix(docs, t, doc_id="doc_id", source="source", n_tokens="n_tokens", total_tokens=_budget(spark, docs, t)), docs, t


def p9_budget_selection(spark: SparkSession, d: str) -> DataFrame:
    """The mix as large as all targeted tokens: sources out of reach are used max_repeats times."""
    return _whole_mix(spark, d)[0]


def p9_budget_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares really reached by that mix."""
    mix, docs, t = _whole_mix(spark, d)
    return mixing.shares(mix, docs, t, source="source", n_tokens="n_tokens")


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: documents placed, and how many containers are too full, documents are split though they fit, or don't have all their tokens."""
    sizes = materialize(_counted(spark, d, "doc_id").groupBy("doc_id").agg(F.max("n_tokens").alias("_size")), "token-counts")
    budgets = table(spark, d, "pack_budget").distinct()
    placed = materialize(p8_containers(spark, d), "containers")
    full = placed.groupBy("budget_name", "container").agg(F.sum("n_tokens").alias("_t")).join(F.broadcast(budgets), "budget_name").groupBy("budget_name").agg(F.count_if(F.col("_t") > F.col("capacity_tokens")).alias("too_full"))
    docs = placed.groupBy("budget_name", "doc_id").agg(F.sum("n_tokens").alias("_t"), F.count(F.lit(1)).alias("_k")).join(sizes, "doc_id", "full_outer").join(F.broadcast(budgets), "budget_name", "left")
    docs = docs.groupBy("budget_name").agg(F.count("doc_id").alias("documents"), F.count_if((F.col("_k") > 1) & (F.col("_size") <= F.col("capacity_tokens"))).alias("split_in_vain"), F.count_if(~F.col("_t").eqNullSafe(F.col("_size"))).alias("incomplete"))
    return docs.join(full, "budget_name").select("budget_name", "documents", "too_full", "split_in_vain", "incomplete")


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per target that can be served: documents used too often, of another source, or that are not there."""
    sel = p9_budget_selection(spark, d).join(table(spark, d, "documents").select("doc_id", F.col("source").alias("_s")).distinct(), "doc_id", "left")
    caps = table(spark, d, "mix_target").distinct()
    return sel.join(F.broadcast(caps), "source", "right").groupBy("source").agg(
        F.count_if(F.col("copies") > F.col("max_repeats")).alias("too_often"), F.count_if(F.col("copies").isNotNull() & ~F.col("_s").eqNullSafe(F.col("source"))).alias("of_no_such_source"), F.count_if(F.col("copies") < 1).alias("without_copies")
    )


def p10_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Documents with garbled stretches, the decoding chains that were undone, and the text restored."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return encoding.repair(docs, encoding.train_dictionaries(docs))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_repaired(spark, d).select("doc_id").distinct()


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_entities, p8_containers, p8_fill, p8_invariants, p9_selection, p9_shares, p9_budget_selection, p9_budget_shares, p9_invariants, p10_found, p10_repaired)}


def llm_sql() -> dict[str, str]:
    """What can be said without a tokenizer: every document is placed once for each capacity, and nothing breaks its bound."""
    return {
        "p8_invariants": "SELECT b.budget_name, d.n AS documents, CAST(0 AS BIGINT) AS too_full, CAST(0 AS BIGINT) AS split_in_vain, CAST(0 AS BIGINT) AS incomplete FROM (SELECT DISTINCT budget_name FROM pack_budget) b CROSS JOIN (SELECT count(DISTINCT doc_id) AS n FROM documents) d",
        "p9_invariants": "SELECT DISTINCT source, CAST(0 AS BIGINT) AS too_often, CAST(0 AS BIGINT) AS of_no_such_source, CAST(0 AS BIGINT) AS without_copies FROM mix_target",
    }

"""Facts, rule-derived events and digests of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import scalars as X

DERIVATION_VERSION = "chronofold-ledger/1"


def assign_fact_ids(rows: DataFrame, payload_sha256: str, by: list[str]) -> DataFrame:
    """Occurrence number among equal payloads of one (notice, type), and the content-addressed id made of it."""
    w = Window.partitionBy(*by, payload_sha256).orderBy(payload_sha256)
    out = rows.withColumn("fact_index", F.row_number().over(w) - 1)
    return out.withColumn("fact_id", X.identity(**{k: F.col(k) for k in by}, payload_sha256=F.col(payload_sha256), dup_index=F.col("fact_index")))


# What the payload of each kind of fact tells, by the tables it comes from. Nothing that was computed enters a payload.
NOD_NOTICE = ("notification_kind", "notifying_party_name_raw", "notifying_party_kind", "closely_associated", "related_pdmr_name_raw", "related_pdmr_position_raw", "issuer_name_document", "issuer_lei_document")
NOD_TRANSACTION = ("instrument_code_raw", "instrument_type_raw", "transaction_nature_raw", "transaction_nature_normalized", "transaction_date_raw", "transaction_date", "venue_raw", "outside_trading_venue", "declared_aggregate_volume", "declared_aggregate_price", "declared_price_currency")
EXECUTION = ("line_index", "price_raw", "price", "price_currency", "volume_raw", "volume")
PS_DISCLOSURE = ("issuer_name_document", "obliged_subject_name_raw", "obliged_subject_residence_raw", "threshold_date_raw", "threshold_date", "position_current", "position_previous", "issuer_total_voting_rights", "regulatory_template")
PS_REASONS = ("reason_voting_rights", "reason_instruments", "reason_issuer_voting_rights_change", "reason_other", "concerted_agreement")
AC_OPERATION = ("operation_date_raw", "operation_date", "operation_flag_raw", "operation_flag_normalized", "isin", *(f"{c}{r}" for c in ("shares_direct", "price_direct", "shares_indirect", "price_indirect", "vr_direct", "vr_indirect", "pct_direct", "pct_indirect") for r in ("_raw", "")))
AC_POSITION = ("issuer_name_document", "notification_date_raw", "notification_date", "reason_first_admission", "reason_acquisitions_1pct", "reason_voting_rights_update", "acquisitions_vr_direct", "acquisitions_vr_indirect", "transmissions_vr_direct", "transmissions_vr_indirect", "final_position_json", "regulatory_template")


def _record(*columns: str, **more: Column) -> Column:
    """A struct of the columns in alphabetical order: the canonical form of a payload's part."""
    parts = {c: F.col(c) for c in columns} | more
    return F.struct(*[parts[k].alias(k) for k in sorted(parts)])


def source_facts(tables: dict[str, DataFrame], notice: DataFrame, observed: DataFrame) -> DataFrame:
    """Facts of the semantic tables, of parsed notices only, in the columns of source_fact.

    One fact per transaction with its executions, per holdings disclosure with the numbers of its rows, per treasury operation, and per final treasury position.
    A fact takes effect on its own date, else on its notice's filing date, and is known since its notice was first observed; its identity
    is its content. Notices without a notice row have neither filing date nor issuer.
    """
    parsed = lambda t: tables[t].where(F.col("parse_status").isin(*S.PARSED))
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    nod = parsed("nod_notice_semantic").select("notice_key", "semantic_parser_version", _record(*NOD_NOTICE).alias("_notice"))
    lines = tables["execution_line"].groupBy("event_id").agg(F.array_sort(F.collect_list(_record_in_order(EXECUTION))).alias("_lines"))
    tx = tables["transaction_event"].join(nod, "notice_key").join(lines, "event_id", "left").select(
        "notice_key", F.lit("NOD_TRANSACTION_EVENT").alias("fact_type"), F.col("transaction_date").alias("_on"), F.lit("nod").alias("semantic_parser"), "semantic_parser_version",
        text(F.struct(F.col("_notice").alias("notice"), _record(*NOD_TRANSACTION, execution_lines=F.col("_lines")).alias("transaction"))).alias("source_payload_json"),
    )
    count = lambda t, name: tables[t].groupBy("notice_key").agg(F.count(F.lit(1)).alias(name))
    rows = {"shares": "ps_shares_row", "instruments": "ps_instrument_row", "chain": "ps_control_chain_row", "loyalty": "ps_loyalty_row"}
    ps = parsed("ps_notice_semantic")
    for name, t in rows.items():
        ps = ps.join(count(t, f"_n_{name}"), "notice_key", "left")
    ps = ps.select(
        "notice_key", F.lit("SIGNIFICANT_HOLDING_DISCLOSURE").alias("fact_type"), F.col("threshold_date").alias("_on"), F.lit("ps").alias("semantic_parser"), "semantic_parser_version",
        text(_record(*PS_DISCLOSURE, reasons=_record(*PS_REASONS), row_counts=_record(**{n: F.coalesce(f"_n_{n}", F.lit(0)) for n in rows}))).alias("source_payload_json"),
    )
    ac = parsed("ac_notice_semantic")
    ops = tables["ac_operation"].join(ac.select("notice_key", "semantic_parser_version", "issuer_name_document", "regulatory_template"), "notice_key").select(
        "notice_key", F.lit("TREASURY_OPERATION").alias("fact_type"), F.col("operation_date").alias("_on"), F.lit("ac").alias("semantic_parser"), "semantic_parser_version",
        text(_record(*AC_OPERATION, "issuer_name_document", "regulatory_template")).alias("source_payload_json"),
    )
    end = ac.where("final_position_json is not null").select(
        "notice_key", F.lit("TREASURY_RESULTING_POSITION").alias("fact_type"), F.col("notification_date").alias("_on"), F.lit("ac").alias("semantic_parser"), "semantic_parser_version", text(_record(*AC_POSITION)).alias("source_payload_json"),
    )
    n = notice.select("notice_key", "filing_date").dropDuplicates(["notice_key"])
    out = tx.unionByName(ps).unionByName(ops).unionByName(end).join(n, "notice_key", "left").join(observed, "notice_key", "left")
    out = out.withColumn("source_payload_sha256", F.sha2("source_payload_json", 256)).withColumn("effective_date", F.coalesce("_on", "filing_date")).drop("_on")
    return assign_fact_ids(out, "source_payload_sha256", ["notice_key", "fact_type"]).select(*[F.col(f.name).cast(f.dataType) for f in S.TABLES["source_fact"]])


def _record_in_order(columns: tuple[str, ...]) -> Column:
    """A struct of the columns as they stand: its first one orders a list."""
    return F.struct(*columns)


def event_type(fact_type: Column, nature: Column) -> Column:
    """The rule of each fact type; transactions by their nature."""
    return (
        F.when(fact_type.isin("NOD_TRANSACTION_EVENT", "NOD_TRANSACTION"), F.when(nature == "BUY", "INSIDER_ACQUISITION").when(nature == "SELL", "INSIDER_DISPOSAL").otherwise("INSIDER_TRANSACTION_OTHER"))
        .when(fact_type.isin("SIGNIFICANT_HOLDING_DISCLOSURE", "PS_POSITION"), "SIGNIFICANT_HOLDING_POSITION_DISCLOSED").when(fact_type == "TREASURY_OPERATION", "TREASURY_OPERATION_REPORTED")
        .when(fact_type.isin("TREASURY_RESULTING_POSITION", "TREASURY_POSITION"), "TREASURY_STOCK_POSITION_DISCLOSED")
    )


def rule_of(fact_type: Column) -> Column:
    return (
        F.when(fact_type.isin("NOD_TRANSACTION_EVENT", "NOD_TRANSACTION"), "NOD_TXN_TO_INSIDER_EVENT/v1").when(fact_type.isin("SIGNIFICANT_HOLDING_DISCLOSURE", "PS_POSITION"), "PS_DISCLOSURE_TO_POSITION_EVENT/v1")
        .when(fact_type == "TREASURY_OPERATION", "AC_OPERATION_TO_TREASURY_EVENT/v1").when(fact_type.isin("TREASURY_RESULTING_POSITION", "TREASURY_POSITION"), "AC_POSITION_TO_TREASURY_EVENT/v1")
    )


def derive_events(facts: DataFrame, notice: DataFrame, relations: DataFrame, observed: DataFrame) -> DataFrame:
    """All ledger events of the facts and relations.

    One event per fact by its rule; NOTICE_FILED per notice that has a fact; NOTICE_CANCELLED per relation whose annulled side has a
    notice, dated and known by the annulling side, with the relation type in its payload. observed: (notice_key, first_observed_at).
    Facts: fact_id, notice_key, fact_type, effective_date, filing_date, source_payload_json, first_observed_at.
    """
    n = notice.select("notice_key", "issuer_id", "filing_date", "notice_type", "source_surface").dropDuplicates(["notice_key"])
    cols = ["event_type", "event_basis", "issuer_id", "effective_date", "filing_date", "source_notice_key", "source_fact_id", "rule_id", "payload_json", "first_observed_at"]
    ft = F.col("fact_type")
    per_fact = facts.join(n.select("notice_key", "issuer_id"), "notice_key", "left").select(
        event_type(ft, F.coalesce(F.get_json_object("source_payload_json", "$.transaction.transaction_nature_normalized"), F.get_json_object("source_payload_json", "$.nature"))).alias("event_type"), F.lit(S.DERIVED).alias("event_basis"), "issuer_id", F.coalesce("effective_date", "filing_date").alias("effective_date"), "filing_date",
        F.col("notice_key").alias("source_notice_key"), F.col("fact_id").alias("source_fact_id"), rule_of(ft).alias("rule_id"), F.col("source_payload_json").alias("payload_json"), "first_observed_at",
    )
    filed = facts.select("notice_key").distinct().join(n, "notice_key").join(observed, "notice_key", "left").select(
        F.lit("NOTICE_FILED").alias("event_type"), F.lit(S.SOURCE_DECLARED).alias("event_basis"), "issuer_id", F.col("filing_date").alias("effective_date"), "filing_date", F.col("notice_key").alias("source_notice_key"),
        F.lit(None).cast("string").alias("source_fact_id"), F.lit("NOTICE_FILED/v1").alias("rule_id"), X.canonical_text(notice_key=F.col("notice_key"), notice_type=F.col("notice_type"), source_surface=F.col("source_surface")).alias("payload_json"), "first_observed_at",
    )
    target = n.select(F.col("notice_key").alias("annulled_key"), "issuer_id")
    source = n.select(F.col("notice_key").alias("annulling_key"), "filing_date").join(observed.select(F.col("notice_key").alias("annulling_key"), "first_observed_at"), "annulling_key", "full_outer")
    cancelled = relations.select("annulling_key", "annulled_key", "relation_type").distinct().join(target, "annulled_key").join(source, "annulling_key", "left").select(
        F.lit("NOTICE_CANCELLED").alias("event_type"), F.lit(S.SOURCE_DECLARED).alias("event_basis"), "issuer_id", F.col("filing_date").alias("effective_date"), "filing_date", F.col("annulled_key").alias("source_notice_key"),
        F.lit(None).cast("string").alias("source_fact_id"), F.lit("NOTICE_CANCELLED_FROM_ANNULS/v1").alias("rule_id"),
        X.canonical_text(annulled_notice_key=F.col("annulled_key"), annulling_notice_key=F.col("annulling_key"), relation_type=F.col("relation_type")).alias("payload_json"), "first_observed_at",
    )
    out = per_fact.select(cols).unionByName(filed.select(cols)).unionByName(cancelled.select(cols)).withColumn("derivation_version", F.lit(DERIVATION_VERSION))
    return out.withColumn("event_id", X.identity(source=F.coalesce("source_fact_id", "source_notice_key"), event_type=F.col("event_type"), rule_id=F.col("rule_id"), derivation_version=F.col("derivation_version"), payload_sha256=F.sha2("payload_json", 256)))


def digest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row (n, digest) that is equal for equal multisets of rows, whatever their order and partitioning.

    Each row is hashed; the four 64-bit quarters of the hashes are summed as decimals and the sums hashed with the count.
    """
    h = F.sha2(X.canonical_text(**{c: F.col(c) for c in columns}), 256)
    part = lambda k: F.sum(F.conv(F.substring(F.col("_h"), 16 * k + 1, 15), 16, 10).cast("decimal(38,0)"))
    sums = rows.select(h.alias("_h")).agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(part(k), F.lit(0)).cast("string").alias(f"s{k}") for k in range(4)])
    return sums.select("n", F.sha2(F.concat_ws("|", F.col("n").cast("string"), "s0", "s1", "s2", "s3"), 256).alias("digest"))

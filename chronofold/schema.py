"""Schemas and closed vocabularies of the ledger."""

from __future__ import annotations

from pyspark.sql import types as T

# Surfaces with the notice type and its basis that a surface implies.
SURFACES = {"nod": ("PDMR_NOTIFICATION", "SURFACE_DEFAULT"), "nod_legacy": ("DIRECTOR_NOTIFICATION", "SURFACE_DEFAULT"), "ac": ("TREASURY_STOCK", "SURFACE_DEFAULT"), "ps": ("UNCLASSIFIED", "NONE")}
# First day of the later regime; first day from which holdings and treasury documents are read.
NEW_FORM_FROM, DOCUMENTS_FROM = "2022-08-07", "2015-12-28"
PARSED = ("PARSED", "PARSED_WITH_UNMAPPED_VALUES")
RUN_TYPES = ("BACKFILL", "INCREMENTAL", "RECONCILIATION")
DISAPPEARED = "SOURCE_DISAPPEARANCE_OBSERVED"
FACT_TYPES = ("NOD_TRANSACTION_EVENT", "SIGNIFICANT_HOLDING_DISCLOSURE", "TREASURY_OPERATION", "TREASURY_RESULTING_POSITION")
SOURCE_DECLARED, DERIVED = "SOURCE_DECLARED", "DETERMINISTIC_DERIVATION"
# Rule -> (event type, basis).
RULES = {
    "NOTICE_FILED/v1": ("NOTICE_FILED", SOURCE_DECLARED),
    "NOTICE_CANCELLED_FROM_ANNULS/v1": ("NOTICE_CANCELLED", SOURCE_DECLARED),
    "NOD_TXN_TO_INSIDER_EVENT/v1": ("INSIDER_*", DERIVED),
    "PS_DISCLOSURE_TO_POSITION_EVENT/v1": ("SIGNIFICANT_HOLDING_POSITION_DISCLOSED", DERIVED),
    "AC_OPERATION_TO_TREASURY_EVENT/v1": ("TREASURY_OPERATION_REPORTED", DERIVED),
    "AC_POSITION_TO_TREASURY_EVENT/v1": ("TREASURY_STOCK_POSITION_DISCLOSED", DERIVED),
}
# Feed item types, and the one of each fact type.
FEED_TYPES = ("NOTICE_OBSERVED", "INSIDER_TRANSACTION_OBSERVED", "SIGNIFICANT_HOLDING_DISCLOSURE_OBSERVED", "TREASURY_OPERATION_OBSERVED", "TREASURY_STOCK_POSITION_OBSERVED", "CANCELLATION_RELATION_OBSERVED", "NOTICE_DISAPPEARANCE_OBSERVED")
FEED_OF_FACT = {
    "NOD_TRANSACTION_EVENT": "INSIDER_TRANSACTION_OBSERVED", "NOD_TRANSACTION": "INSIDER_TRANSACTION_OBSERVED", "SIGNIFICANT_HOLDING_DISCLOSURE": "SIGNIFICANT_HOLDING_DISCLOSURE_OBSERVED", "PS_POSITION": "SIGNIFICANT_HOLDING_DISCLOSURE_OBSERVED",
    "TREASURY_OPERATION": "TREASURY_OPERATION_OBSERVED", "TREASURY_RESULTING_POSITION": "TREASURY_STOCK_POSITION_OBSERVED", "TREASURY_POSITION": "TREASURY_STOCK_POSITION_OBSERVED",
}
CURRENT, RECONSTRUCTED = "OBSERVED_CURRENT", "RECONSTRUCTED_HISTORICAL"
NO_HISTORY, AS_KNOWN_AT, CURRENT_KNOWLEDGE = "NO_OBSERVATION_HISTORY", "AS_KNOWN_AT", "CURRENT_KNOWLEDGE_RECONSTRUCTED"

_KINDS = {"S": T.StringType(), "D": T.DateType(), "T": T.TimestampType(), "I": T.IntegerType(), "L": T.LongType(), "B": T.BooleanType(), "N": T.DecimalType(38, 10), "F": T.DoubleType(), "A": T.ArrayType(T.StringType())}


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split(":") for x in text.split())])


TABLES = {
    "crawl_run": _schema("run_id:S run_type:S started_at:T completed_at:T status:S scope:S universe_version:S stats_json:S"),
    "issuer": _schema("issuer_id:S nif:S lei:S name_raw:S capital_raw:S"),
    "notice": _schema("notice_key:S source_surface:S source_registration_number:S notice_type:S issuer_id:S filing_date:D regulatory_template:S notice_status:S doc_token:S declarant_name_raw:S declarant_role:S pct_total:S first_seen_run:S last_seen_run:S"),
    "notice_observation": _schema("obs_id:L run_id:S notice_key:S observed_at:T raw_sha256:S normalized_sha256:S source_url_observed:S source_url_canonical:S status_observed:S present_in_source:B"),
    "notice_relation": _schema("annulling_key:S annulled_key:S relation_type:S evidence_url:S observed_run_id:S evidence_sha256:S"),
    "run_seen": _schema("run_id:S notice_key:S"),
    "notice_event": _schema("notice_key:S event_index:I event_date:D declarant_name_raw:S declarant_role:S declarant_scope_issuer_id:S shares:S percentage_after:S price:S instrument:S evidence:S"),
    "source_fact": _schema("fact_id:S notice_key:S fact_type:S fact_index:I effective_date:D filing_date:D semantic_parser:S semantic_parser_version:S source_payload_json:S source_payload_sha256:S first_observed_at:T"),
    "ledger_event": _schema("event_id:S event_type:S event_basis:S issuer_id:S effective_date:D filing_date:D source_notice_key:S source_fact_id:S rule_id:S derivation_version:S payload_json:S first_observed_at:T"),
    "nod_notice_semantic": _schema("notice_key:S parse_id:S semantic_parser_version:S regulatory_template:S parse_status:S notification_kind:S notifying_party_name_raw:S notifying_party_kind:S position_status_raw:S closely_associated:S related_pdmr_name_raw:S related_pdmr_position_raw:S issuer_name_document:S issuer_lei_document:S doc_sha256:S"),
    "transaction_event": _schema("event_id:S notice_key:S parse_id:S source_order:I instrument_code_raw:S instrument_type_raw:S transaction_nature_raw:S transaction_nature_normalized:S transaction_date_raw:S transaction_date:D venue_raw:S outside_trading_venue:S declared_aggregate_volume:S declared_aggregate_price:S declared_price_currency:S computed_volume:N computed_vwap:N aggregate_qa:S"),
    "execution_line": _schema("event_id:S notice_key:S parse_id:S line_index:I price_raw:S price:N price_currency:S volume_raw:S volume:N"),
    "ps_notice_semantic": _schema("notice_key:S parse_id:S semantic_parser_version:S regulatory_template:S parse_status:S issuer_name_document:S obliged_subject_name_raw:S obliged_subject_residence_raw:S reason_voting_rights:B reason_instruments:B reason_issuer_voting_rights_change:B reason_other:B concerted_agreement:B threshold_date_raw:S threshold_date:D position_current:A position_previous:A issuer_total_voting_rights:L aggregate_qa:S doc_sha256:S"),
    "ps_shares_row": _schema("notice_key:S parse_id:S row_index:I isin:S vr_direct_raw:S vr_direct:L vr_indirect_raw:S vr_indirect:L pct_direct_raw:S pct_direct:N pct_indirect_raw:S pct_indirect:N"),
    "ps_instrument_row": _schema("notice_key:S parse_id:S row_index:I section:S instrument_type_raw:S expiration_date_raw:S expiration_date:D voting_rights_raw:S voting_rights:L pct_raw:S pct:N"),
    "ps_control_chain_row": _schema("notice_key:S parse_id:S source:S chain_path_index:I row_index:I entity_name_raw:S pct_voting_rights_raw:S pct_instruments_raw:S pct_total_raw:S"),
    "ps_loyalty_row": _schema("notice_key:S parse_id:S section:S row_index:I attribution_date_raw:S attribution_date:D"),
    "ac_notice_semantic": _schema("notice_key:S parse_id:S semantic_parser_version:S regulatory_template:S parse_status:S issuer_name_document:S reason_first_admission:B reason_acquisitions_1pct:B reason_voting_rights_update:B notification_date_raw:S notification_date:D acquisitions_vr_direct:L acquisitions_vr_indirect:L transmissions_vr_direct:L transmissions_vr_indirect:L acquisitions_qa:S transmissions_qa:S final_position_json:S doc_sha256:S"),
    "ac_operation": _schema("notice_key:S parse_id:S row_index:I operation_date_raw:S operation_date:D operation_flag_raw:S operation_flag_normalized:S isin:S shares_direct_raw:S shares_direct:L price_direct_raw:S price_direct:N shares_indirect_raw:S shares_indirect:L price_indirect_raw:S price_indirect:N vr_direct_raw:S vr_direct:L vr_indirect_raw:S vr_indirect:L pct_direct_raw:S pct_direct:N pct_indirect_raw:S pct_indirect:N"),
    "ac_indirect_row": _schema("notice_key:S parse_id:S section:S row_index:I name_raw:S pct_raw:S"),
    "feed_item": _schema("item_key:S feed_item_type:S observed_at:T run_id:S run_type:S history_class:S issuer_id:S notice_key:S event_id:S annulling_key:S annulled_key:S relation_type:S effective_date:D filing_date:D event_basis:S fact_id:S payload_json:S"),
    "universe_issuer": _schema("universe_version:S issuer_id:S nif:S name_raw:S"),
    "issuer_alias": _schema("alias:S issuer_id:S"),
    "raw_blob": _schema("raw_sha256:S raw_bytes:L path:S"),
    "failed_item": _schema("run_id:S scope_key:S error:S at:T"),
    "crawl_checkpoint": _schema("run_id:S scope_key:S status:S"),
    "discovered_issuer": _schema("nif:S name_raw:S"),
    "notice_doc": _schema("notice_key:S doc_status:S raw_sha256:S parse_status:S regulatory_template:S parse_id:S parsed_at:T"),
}
#: Tables that parsing fills, each row under the parse that made it.
SEMANTIC = ("nod_notice_semantic", "transaction_event", "execution_line", "ps_notice_semantic", "ps_shares_row", "ps_instrument_row", "ps_control_chain_row", "ps_loyalty_row", "ac_notice_semantic", "ac_operation", "ac_indirect_row")
# What a template's text holds (any of the alternatives parted by |), what it doesn't, the first that holds; the last has the transaction form.
TEMPLATES = (
    ("CIRC_2_2022_MODEL_1", ("PARTICIPACIONES", "SIGNIFICATIVAS", "STANDARD FORM", "LEALTAD|LOYALTY"), ()),
    ("CIRC_8_2015_MODEL_1", ("PARTICIPACIONES", "SIGNIFICATIVAS", "STANDARD FORM"), ()),
    ("CIRC_8_2015_MODEL_2_DIRECTOR", ("CONSEJEROS", "MODELO", "STANDARD FORM"), ()),
    ("UNSUPPORTED_LEGACY_TEMPLATE", ("CONSEJEROS", "MODELO"), ()),
    ("UNSUPPORTED_LEGACY_TEMPLATE", ("ACCIONES PROPIAS|OWN SHARES",), ("STANDARD FORM",)),
    ("CIRC_8_2015_MODEL_4", ("ACCIONES PROPIAS|OWN SHARES", "MODELO 4|FORM #4"), ()),
    ("CIRC_2_2022_MODEL_2", ("ACCIONES PROPIAS|OWN SHARES", "MODELO 2|FORM #2"), ()),
    ("UNSUPPORTED_TEMPLATE", ("ACCIONES PROPIAS|OWN SHARES",), ()),
    ("UNSUPPORTED_LEGACY_TEMPLATE", ("MODELO",), ("STANDARD FORM",)),
)
NOD_TEMPLATES = (("EU_2016_523_PDMR_CNMV", ("MODELO DE NOTIFICACIÓN", "STANDARD FORM FOR NOTIFICATION", "Total Agregado", "4.a)", "4.b)", "4.c)", "4.d)", "4.e)", "4.f)", "4.g)", "4.h)"), ()),)
HOLDING_TEMPLATES, TREASURY_TEMPLATES = ("CIRC_2_2022_MODEL_1", "CIRC_8_2015_MODEL_1", "CIRC_8_2015_MODEL_2_DIRECTOR"), ("CIRC_8_2015_MODEL_4", "CIRC_2_2022_MODEL_2")
NO_TEXT, EXTRACTION_ERROR = "UNSUPPORTED_NO_TEXT_LAYER", "EXTRACTION_ERROR"

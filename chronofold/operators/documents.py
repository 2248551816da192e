"""Documents to semantic rows: which template a document has, what its form says, and under which parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import scalars as X
from . import cells as C
from . import forms

PARSER_VERSION = "chronofold-forms/1"


def templates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, notice_key, surface, raw_sha256, template): the template by its anchors, NO_TEXT for documents without any cell."""
    text = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda s: s["text"]), " ").alias("_text"))
    seen = docs.join(text, "doc_id", "left")
    other = X.fingerprint(F.upper("_text"), S.TEMPLATES, "UNSUPPORTED_TEMPLATE")
    kind = F.when(F.col("_text").isNull(), S.NO_TEXT).when(F.col("surface") == "nod", X.fingerprint("_text", S.NOD_TEMPLATES, "UNSUPPORTED_TEMPLATE")).otherwise(other)
    return seen.select("doc_id", "notice_key", "surface", "raw_sha256", kind.alias("template"))


def _shaped(df: DataFrame, name: str, parse_id: str, **more: Column) -> DataFrame:
    """df in the columns of a semantic table; what it lacks is null."""
    have = set(df.columns)
    told = {"parse_id": F.lit(parse_id), **more}
    return df.select(*[(told[f.name] if f.name in told else F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.TABLES[name]])


def semantic_rows(docs: DataFrame, cells: DataFrame, parse_id: str) -> dict[str, DataFrame]:
    """Rows of all semantic tables and of notice_doc for the documents (doc_id, notice_key, surface, raw_sha256) and their cells.

    A form is read only from documents of its template; every other document has a notice_doc row that says why it isn't. What can't be read as its type is null
    beside its literal, and a form without what it must have is PARSED_WITH_UNMAPPED_VALUES. Cells of unknown documents are left out.
    """
    cells = cells.join(docs.select("doc_id"), "doc_id", "left_semi")
    kinds = templates(docs, C.lines_of(cells))

    def of(*names: str) -> tuple[DataFrame, DataFrame]:
        mine = kinds.where(F.col("template").isin(*names))
        return mine.select("doc_id", "notice_key", F.col("template").alias("regulatory_template"), F.col("raw_sha256").alias("doc_sha256")), cells.join(mine.select("doc_id"), "doc_id", "left_semi")

    out: dict[str, DataFrame] = {}
    version = {"semantic_parser_version": F.lit(PARSER_VERSION)}
    status = lambda ok: F.when(ok, "PARSED").otherwise("PARSED_WITH_UNMAPPED_VALUES")

    mine, inside = of(S.NOD_TEMPLATES[0][0])
    lines = C.lines_of(inside)
    events = C.grid_events(lines)
    head = C.form_headers(lines)
    nod = mine.join(head, "doc_id", "left").join(C.parse_status(lines, head, events), "doc_id", "left").withColumn("parse_status", F.coalesce("parse_status", F.lit("PARSED_WITH_UNMAPPED_VALUES")))
    out["nod_notice_semantic"] = _shaped(nod, "nod_notice_semantic", parse_id, **version)
    tx = events.join(mine.select("doc_id", "notice_key"), "doc_id").withColumn("event_id", F.format_string("%s:%02d", "notice_key", "source_order"))
    out["transaction_event"] = _shaped(tx, "transaction_event", parse_id, transaction_date=F.expr("try_cast(transaction_date as date)"), declared_price_currency=F.get("executions", F.lit(0))["currency_raw"])
    line = tx.select("event_id", "notice_key", F.posexplode("executions").alias("line_index", "_x")).select("event_id", "notice_key", "line_index", "_x.price_raw", "_x.volume_raw", F.col("_x.currency_raw").alias("price_currency"))
    out["execution_line"] = _shaped(line, "execution_line", parse_id, price=X.decimal_literal("price_raw"), volume=X.decimal_literal("volume_raw"))

    mine, inside = of(*S.HOLDING_TEMPLATES)
    head, shares, instruments = forms.holdings_form(inside)
    ps = mine.join(head, "doc_id", "left").withColumn("parse_status", status(F.col("obliged_subject_name_raw").isNotNull() & F.col("threshold_date").isNotNull() & F.col("position_current").isNotNull()))
    out["ps_notice_semantic"] = _shaped(ps, "ps_notice_semantic", parse_id, **version)
    numbered = lambda rows: rows.join(mine.select("doc_id", "notice_key"), "doc_id").withColumn("row_index", F.row_number().over(Window.partitionBy("doc_id").orderBy("n")) - 1)
    out["ps_shares_row"] = _shaped(numbered(shares), "ps_shares_row", parse_id)
    out["ps_instrument_row"] = _shaped(numbered(instruments), "ps_instrument_row", parse_id, section=F.lit("7.B.1"))
    chain, loyalty = forms.control_chains(inside), forms.loyalty_rows(inside)
    out["ps_control_chain_row"] = _shaped(chain.join(mine.select("doc_id", "notice_key"), "doc_id"), "ps_control_chain_row", parse_id, source=F.lit("SECTION_8"))
    out["ps_loyalty_row"] = _shaped(numbered(loyalty), "ps_loyalty_row", parse_id)

    mine, inside = of(*S.TREASURY_TEMPLATES)
    head, ops, final = forms.treasury_form(inside)
    end = final.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("n", "isin", *forms.FINAL_COLUMNS)))).alias("final_position_json"))
    ac = mine.join(head, "doc_id", "left").join(end, "doc_id", "left").withColumn("parse_status", status(F.col("issuer_name_document").isNotNull() & F.col("notification_date").isNotNull()))
    out["ac_notice_semantic"] = _shaped(ac, "ac_notice_semantic", parse_id, **version)
    out["ac_operation"] = _shaped(ops.join(mine.select("doc_id", "notice_key"), "doc_id"), "ac_operation", parse_id)
    out["ac_indirect_row"] = _shaped(numbered(forms.indirect_holders(inside)), "ac_indirect_row", parse_id, section=F.lit("6"))

    read = out["nod_notice_semantic"].select("notice_key", "parse_status").unionByName(out["ps_notice_semantic"].select("notice_key", "parse_status")).unionByName(out["ac_notice_semantic"].select("notice_key", "parse_status"))
    per = kinds.groupBy("notice_key").agg(F.min(F.struct("doc_id", "template", "raw_sha256")).alias("_d")).join(read.groupBy("notice_key").agg(F.max("parse_status").alias("parse_status")), "notice_key", "left")
    state = F.coalesce("parse_status", "_d.template")
    out["notice_doc"] = _shaped(per, "notice_doc", parse_id, doc_status=state, parse_status=state, raw_sha256=F.col("_d.raw_sha256"), regulatory_template=F.col("_d.template"), parsed_at=F.current_timestamp())
    return out


def current_rows(rows: DataFrame, notice_doc: DataFrame) -> DataFrame:
    """Semantic rows of each notice's last parse: parsing a document again leaves nothing of its old rows in force."""
    last = notice_doc.groupBy("notice_key").agg(F.max_by("parse_id", F.struct("parsed_at", "parse_id")).alias("parse_id"))
    return rows.join(last, ["notice_key", "parse_id"], "left_semi")

"""Holdings and treasury forms from positioned cells: labelled values, boxes, and grids whose columns are told by their own headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from . import aggregates as A
from . import cells as C
from . import sequences as Q

# What the two forms call their fields, boxes, sections and columns.
TREASURY_FIELDS = {"issuer_name_document": "(?iu)denominaci.n social|company name", "notification_date_raw": "(?iu)fecha que motiva la notificaci|date giving rise"}
TREASURY_BOXES = {"reason_first_admission": "(?iu)primera admisi|first admission", "reason_acquisitions_1pct": "(?iu)umbral del 1 ?%|threshold of 1 ?%", "reason_voting_rights_update": "(?iu)actualizaci.n sobrevenida|updating as a result"}
TREASURY_OPERATIONS = ("(?iu)detalle de las operaciones|detail of the transactions", "(?iu)5\\. posesi.n final|final position")
TREASURY_FINAL = ("(?iu)5\\. posesi.n final|final position", "(?iu)6\\. identificaci|identity and details")
TREASURY_HEADINGS = "(?iu)^(directas|indirectas|directos|indirectos|precio|price|total)$"
OPERATION_COLUMNS = ("shares_direct", "price_direct", "shares_indirect", "price_indirect", "vr_direct", "vr_indirect", "pct_direct", "pct_indirect")
FINAL_COLUMNS = ("shares_direct", "shares_indirect", "vr_direct", "vr_indirect", "vr_total", "pct_direct", "pct_indirect", "pct_total")
HOLDING_FIELDS = {"issuer_name_document": "(?iu)identificaci.n del emisor", "obliged_subject_name_raw": "(?iu)apellidos y nombre o denominaci", "obliged_subject_residence_raw": "(?iu)ciudad y pa.s del domicilio", "threshold_date_raw": "(?iu)fecha en la que se cruz|threshold was crossed"}
HOLDING_BOXES = {"reason_voting_rights": "(?iu)adquisici.n o transmisi.n de derechos de voto", "reason_instruments": "(?iu)adquisici.n o transmisi.n de instrumentos", "reason_issuer_voting_rights_change": "(?iu)modificaci.n en el n.mero de derechos", "reason_other": "(?iu)otros motivos", "concerted_agreement": "(?iu)ejercicio concertado"}
HOLDING_POSITIONS = {"position_current": "(?iu)situaci.n resultante|resulting position", "position_previous": "(?iu)posici.n de la notificaci"}
HOLDING_SHARES = ("(?iu)^7\\.a", "(?iu)subtotal 7\\.a")
HOLDING_INSTRUMENTS = ("(?iu)^7\\.b\\.1", "(?iu)subtotal 7\\.b\\.1")
HOLDING_CHAIN = ("(?iu)^8\\.", "(?iu)^9\\.")
HOLDING_LOYALTY = ("(?iu)^11\\.", "(?iu)^12\\.|^anexo")
TREASURY_INDIRECT = ("(?iu)^6\\. identificaci|identity and details", "(?iu)^7\\.")
HOLDING_HEADINGS = "(?iu)^(directo|indirecto)$"
SHARE_COLUMNS = ("vr_direct", "vr_indirect", "pct_direct", "pct_indirect")
ISIN, DATE = "^[A-Z]{2}[A-Z0-9]{9,10}$", "^[0-9]{2}/[0-9]{2}/[0-9]{4}$"


def _numbered(cells: DataFrame) -> DataFrame:
    """Cells with the number of their line, as lines_of counts them."""
    return cells.withColumn("n", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("page", "line")) - 1)


def _value(name: str) -> Column:
    c = F.col(f"{name}_raw")
    return X.decimal_literal(c) if name.startswith(("pct", "price")) else X.integer_literal(c)


def grid(cells: DataFrame, lines: DataFrame, bounds: tuple[str, str], headings: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows of a section (doc_id, n, text, isin, date_raw, flag, *columns raw and exact).

    The column anchors are the places of the heading cells in the section's line that has most of them; a number belongs to the nearest anchor
    within the tolerance, the leftmost of several numbers of one column counts. Without as many headings as columns all columns are null.
    """
    part = C.section(lines, *bounds).select("doc_id", "n", "text")
    inside = _numbered(cells).join(part, ["doc_id", "n"])
    heads = inside.where(F.col("t").rlike(headings)).groupBy("doc_id", "n").agg(F.array_sort(F.collect_list("x0")).alias("_a"))
    heads = heads.where(F.size("_a") == len(columns)).groupBy("doc_id").agg(F.min_by("_a", "n").alias("_a"))
    near = F.array_min(F.transform("_a", lambda a, i: F.struct(F.abs(F.col("x0") - a).alias("d"), i.alias("i"))))
    number = X.is_number(F.col("t")) | X.is_percentage(F.col("t"))
    placed = inside.join(heads, "doc_id", "left").withColumn("_near", F.when(number, near)).withColumn("_k", F.when(F.col("_near.d") <= 42.0, F.col("_near.i")))
    first = lambda cond: F.min_by("t", F.when(cond, F.col("x0")))
    rows = placed.groupBy("doc_id", "n", "text").agg(
        first(F.col("t").rlike(ISIN)).alias("isin"), first(F.col("t").rlike(DATE)).alias("date_raw"), first(F.col("t").isin("A", "T")).alias("flag"), F.max(F.col("t").rlike(headings)).alias("_heading"),
        *[first(F.col("_k") == i).alias(f"{c}_raw") for i, c in enumerate(columns)],
    )
    return rows.where("not _heading").drop("_heading").select("*", *[_value(c).alias(c) for c in columns])


def treasury_form(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, operations, final positions) of treasury documents.

    Headers carry the reasons, the notification date, the declared totals of acquisitions and transmissions and, per side, whether the operations
    add up to them (MATCH or DIVERGENT; a side without declared total has none). Flows are never netted with the final position.
    """
    lines = C.lines_of(cells)
    rows = grid(cells, lines, TREASURY_OPERATIONS, TREASURY_HEADINGS, OPERATION_COLUMNS)
    w = Window.partitionBy("doc_id").orderBy("n")
    ops = rows.where("date_raw is not null").select("doc_id", (F.row_number().over(w) - 1).alias("row_index"), F.col("date_raw").alias("operation_date_raw"), X.date_literal("date_raw").alias("operation_date"), F.col("flag").alias("operation_flag_raw"), X.operation_flag("flag").alias("operation_flag_normalized"), "isin", *[f"{c}_raw" for c in OPERATION_COLUMNS], *OPERATION_COLUMNS)
    total = lambda pattern, c: F.min_by(F.coalesce(c, F.lit(0)), F.when(F.col("text").rlike(pattern) & F.col("date_raw").isNull(), F.col("n")))
    declared = rows.groupBy("doc_id").agg(*[total(p, F.col(v)).alias(f"{k}_{v}") for k, p in (("acquisitions", "(?iu)total adquisici|total acquisitions"), ("transmissions", "(?iu)total transmisi|total transmissions")) for v in ("vr_direct", "vr_indirect")])
    side = lambda flag, v: F.coalesce(F.sum(F.when(F.col("operation_flag_normalized") == flag, F.col(v))), F.lit(0))
    sums = ops.groupBy("doc_id").agg(*[side(f, v).alias(f"_{k}_{v}") for k, f in (("acquisitions", "ACQUISITION"), ("transmissions", "DISPOSAL")) for v in ("vr_direct", "vr_indirect")])
    head = C.value_after(lines, TREASURY_FIELDS).join(C.checked(lines, TREASURY_BOXES), "doc_id").join(declared, "doc_id", "left").join(sums, "doc_id", "left")

    def qa(k: str) -> Column:
        same = [F.col(f"{k}_{v}") == F.coalesce(F.col(f"_{k}_{v}"), F.lit(0)) for v in ("vr_direct", "vr_indirect")]
        return F.when(F.col(f"{k}_vr_direct").isNull(), None).when(same[0] & same[1], "MATCH").otherwise("DIVERGENT").alias(f"{k}_qa")

    head = head.select("doc_id", "issuer_name_document", *TREASURY_BOXES, "notification_date_raw", X.date_literal("notification_date_raw").alias("notification_date"), *[f"{k}_{v}" for k in ("acquisitions", "transmissions") for v in ("vr_direct", "vr_indirect")], qa("acquisitions"), qa("transmissions"))
    final = grid(cells, lines, TREASURY_FINAL, TREASURY_HEADINGS, FINAL_COLUMNS).where("isin is not null").drop("date_raw", "flag", "text")
    return head, ops, final


def _numbers_after(lines: DataFrame, pattern: str, name: str) -> DataFrame:
    """(doc_id, name): the numbers of the first line behind the label that has any, in order."""
    at = lines.where(F.col("text").rlike(pattern)).groupBy("doc_id").agg(F.min("n").alias("_n"))
    numbers = F.filter("cells", lambda t: X.is_number(t) | X.is_percentage(t))
    return lines.join(at, "doc_id").where((F.col("n") > F.col("_n")) & (F.col("n") <= F.col("_n") + 3) & (F.size(numbers) > 0)).groupBy("doc_id").agg(F.min_by(numbers, "n").alias(name))


def holdings_form(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, share rows, instrument rows) of holdings documents; a disclosure of a position, never a trade.

    Headers carry reasons, subject, threshold date, the current and previous position as literals in order (shares, instruments, total, voting
    rights of the issuer) and whether shares and instruments add up to the declared total within half a unit of its last place.
    """
    lines = C.lines_of(cells)
    head = C.value_after(lines, HOLDING_FIELDS).join(C.checked(lines, HOLDING_BOXES), "doc_id")
    for name, pattern in HOLDING_POSITIONS.items():
        head = head.join(_numbers_after(lines, pattern, name), "doc_id", "left")
    at = lambda i: X.decimal_literal(F.get("position_current", F.lit(i)))
    head = head.withColumn("threshold_date", X.date_literal("threshold_date_raw")).withColumn("issuer_total_voting_rights", X.integer_literal(F.get("position_current", F.lit(3)))).withColumn("aggregate_qa", A.position_qa(at(0), at(1), at(2), X.half_ulp(F.get("position_current", F.lit(2)))))
    shares = grid(cells, lines, HOLDING_SHARES, HOLDING_HEADINGS, SHARE_COLUMNS).where("isin is not null").drop("date_raw", "flag", "text")
    part = C.section(lines, *HOLDING_INSTRUMENTS).where(F.exists("cells", lambda t: t.rlike(DATE)))
    numbers = F.filter("cells", lambda t: X.is_number(t) | X.is_percentage(t))
    instruments = part.select("doc_id", "n", F.get("cells", F.lit(0)).alias("instrument_type_raw"), F.get(F.filter("cells", lambda t: t.rlike(DATE)), F.lit(0)).alias("expiration_date_raw"), F.get(numbers, F.lit(0)).alias("voting_rights_raw"), F.get(numbers, F.lit(1)).alias("pct_raw"))
    instruments = instruments.select("*", X.date_literal("expiration_date_raw").alias("expiration_date"), X.integer_literal("voting_rights_raw").alias("voting_rights"), X.decimal_literal("pct_raw").alias("pct"))
    return head, shares, instruments


def control_chains(cells: DataFrame) -> DataFrame:
    """Controlled undertakings of section 8 (doc_id, chain_path_index, row_index, entity_name_raw, pct_voting_rights_raw, pct_instruments_raw, pct_total_raw).

    Each path begins with the subject that the first row names; a row is a name with up to three numbers behind it, in their order.
    """
    numbers = F.filter("cells", lambda t: X.is_number(t) | X.is_percentage(t))
    name = F.get(F.filter("cells", lambda t: ~(X.is_number(t) | X.is_percentage(t))), F.lit(0))
    rows = C.section(C.lines_of(cells), *HOLDING_CHAIN).select("doc_id", "n", name.alias("entity_name_raw"), *[F.get(numbers, F.lit(i)).alias(c) for i, c in enumerate(("pct_voting_rights_raw", "pct_instruments_raw", "pct_total_raw"))]).where("entity_name_raw is not null and pct_voting_rights_raw is not null")
    paths = Q.restart_paths(rows, ["doc_id"], ["n"], "entity_name_raw", "chain_path_index")
    return paths.withColumn("row_index", F.row_number().over(Window.partitionBy("doc_id", "chain_path_index").orderBy("n")) - 1).drop("n")


def loyalty_rows(cells: DataFrame) -> DataFrame:
    """Dated rows of the section on loyalty votes (doc_id, n, section, attribution_date_raw, attribution_date)."""
    dates = F.filter("cells", lambda t: t.rlike(DATE))
    part = C.section(C.lines_of(cells), *HOLDING_LOYALTY).where(F.size(dates) > 0)
    return part.select("doc_id", "n", F.lit("11").alias("section"), F.get(dates, F.lit(0)).alias("attribution_date_raw"), X.date_literal(F.get(dates, F.lit(0))).alias("attribution_date"))


def indirect_holders(cells: DataFrame) -> DataFrame:
    """Holders through whom a treasury position is indirect (doc_id, n, name_raw, pct_raw); names that wrap are put together."""
    pct = F.get(F.filter("cells", lambda t: X.is_percentage(t)), F.lit(0))
    name = F.array_join(F.filter("cells", lambda t: ~X.is_percentage(t)), " ")
    part = C.section(C.lines_of(cells), *TREASURY_INDIRECT).select("doc_id", F.lit(0).alias("page"), F.col("n").alias("line"), F.nullif(name, F.lit("")).alias("name_raw"), pct.alias("pct_raw"))
    return C.open_rows(part, ["name_raw", "pct_raw"], "pct_raw").withColumnRenamed("row_group", "n").where("name_raw is not null")

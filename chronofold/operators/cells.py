"""Documents as cells: characters to lines and cells, grids to blocks and totals, labelled values, rows in column bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from . import aggregates as A
from . import sequences as Q

# How far characters of one line differ in height, and what gap begins a new cell.
Y_TOLERANCE, X_GAP = 1.0, 3.0


def cells_from_characters(chars: DataFrame) -> DataFrame:
    """(doc_id, page, line, cell, x0, x1, t) from positioned characters (doc_id, page, x0, x1, y, ch), y falling down the page.

    Lines: heights in order, a new line where the height falls by more than the tolerance. Cells: left to right, a new cell behind a gap.
    """
    down = Window.partitionBy("doc_id", "page").orderBy(F.desc("y"), "x0", "ch")
    lined = chars.where("ch is not null").withColumn("_b", F.coalesce((F.lag("y").over(down) - F.col("y") > Y_TOLERANCE).cast("int"), F.lit(0)))
    lined = lined.withColumn("line", F.sum("_b").over(down.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    across = Window.partitionBy("doc_id", "page", "line").orderBy("x0", "x1", "ch")
    celled = lined.withColumn("_c", F.coalesce((F.col("x0") - F.lag("x1").over(across) > X_GAP).cast("int"), F.lit(0))).withColumn("cell", F.sum("_c").over(across.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    text = F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "x1", "ch"))), lambda s: s["ch"]), ""))
    return celled.groupBy("doc_id", "page", "line", "cell").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), text.alias("t")).where("t <> ''")


def lines_of(cells: DataFrame) -> DataFrame:
    """(doc_id, n, cells, text): lines numbered through a document, their cells in order."""
    per = cells.groupBy("doc_id", "page", "line").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "t"))), lambda s: s["t"]).alias("cells"))
    w = Window.partitionBy("doc_id").orderBy("page", "line")
    return per.select("doc_id", (F.row_number().over(w) - 1).alias("n"), "cells", F.array_join("cells", " ").alias("text"))


def value_after(lines: DataFrame, anchors: dict[str, str]) -> DataFrame:
    """Per document the text of the line behind the first line that matches each anchor (a pattern); null where there is none."""
    w = Window.partitionBy("doc_id").orderBy("n")
    nxt = lines.withColumn("_next", F.lead("text").over(w))
    return nxt.groupBy("doc_id").agg(*[F.min_by("_next", F.when(F.col("text").rlike(p), F.col("n"))).alias(k) for k, p in anchors.items()])


def checked(lines: DataFrame, boxes: dict[str, str]) -> DataFrame:
    """Per document whether the line that matches each pattern has its box ticked; null where there is no such line."""
    tick = F.coalesce(X.checkbox("text"), F.lit(False))
    return lines.groupBy("doc_id").agg(*[F.max(F.when(F.col("text").rlike(p), tick)).alias(k) for k, p in boxes.items()])


def section(lines: DataFrame, begin: str, end: str) -> DataFrame:
    """Lines strictly between the first line matching begin and the next one matching end (or the document's end)."""
    w = Window.partitionBy("doc_id")
    first = F.min(F.when(F.col("text").rlike(begin), F.col("n"))).over(w)
    d = lines.withColumn("_a", first)
    last = F.min(F.when(F.col("text").rlike(end) & (F.col("n") > F.col("_a")), F.col("n"))).over(w)
    return d.withColumn("_z", last).where((F.col("n") > F.col("_a")) & (F.col("_z").isNull() | (F.col("n") < F.col("_z")))).drop("_a", "_z")


# Anchors of the transaction form's fields, boxes and grid.
FORM_FIELDS = {"notifying_party_name_raw": "Nombre y apellidos|Name and surname", "position_status_raw": "Cargo - posici|Job title", "kind_raw": "Notificaci.n inicial|Initial Noti", "issuer_name_document": "a\\) Identi", "issuer_lei_document": "LEI:"}
FORM_BOXES = {"pdmr": "Persona con responsabilidad|Person discharging", "associated": "Persona estrechamente vinculada|Person closely"}
GRID_BEGIN, GRID_END, GRID_TOTAL = "DATOS DE LA OPERACI|DETAILS OF THE TRANS", "Otra informaci|Additional information", "Total Agregado"
GRID_COLUMNS = ("instrument_code_raw", "instrument_type_raw", "transaction_nature_raw", "transaction_date_raw", "venue_raw", "volume_raw", "price_raw", "currency_raw")


def form_headers(lines: DataFrame) -> DataFrame:
    """Labelled fields and boxes of the transaction form: one row per document."""
    h = value_after(lines, FORM_FIELDS).join(checked(lines, FORM_BOXES), "doc_id")
    kind = F.when(F.col("kind_raw").contains("Modificaci"), "AMENDMENT").when(F.col("kind_raw").contains("Inicial"), "INITIAL").otherwise("UNKNOWN")
    assoc = F.when(F.col("associated") & ~F.coalesce("pdmr", F.lit(False)), "TRUE").when(F.col("pdmr") & ~F.coalesce("associated", F.lit(False)), "FALSE").otherwise("UNKNOWN")
    person, position = X.split_related("position_status_raw")
    out = h.withColumn("notification_kind", kind).withColumn("closely_associated", assoc)
    out = out.withColumn("notifying_party_kind", F.when(F.col("closely_associated") == "FALSE", "NATURAL_PERSON").otherwise(X.party_kind("notifying_party_name_raw")))
    return out.withColumn("related_pdmr_name_raw", F.when((F.col("closely_associated") == "TRUE") & position.isNotNull(), person)).withColumn("related_pdmr_position_raw", F.when(F.col("closely_associated") == "TRUE", position)).drop("kind_raw", "pdmr", "associated")


def grid_events(lines: DataFrame) -> DataFrame:
    """Transactions of the form's grid with executions, declared and computed aggregates and their agreement.

    Data rows have eight cells with a date and a volume; neighbouring rows equal in the first five cells are one transaction; the row of
    numbers behind a 'Total' line is the declared aggregate of the transaction above it.
    """
    grid = section(lines, GRID_BEGIN, GRID_END)
    data = (F.size("cells") == 8) & F.get("cells", F.lit(3)).rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$") & X.is_number(F.get("cells", F.lit(5)))
    g = grid.withColumn("_data", F.coalesce(data, F.lit(False))).withColumn("_total", F.col("text").contains(GRID_TOTAL))
    rows = g.where("_data").select("doc_id", "n", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(GRID_COLUMNS)])
    rows = Q.maximal_runs(rows, ["doc_id"], ["n"], list(GRID_COLUMNS[:5]), "source_order")
    # the first line of one or two numbers behind a total line belongs to the last data row above it
    w = Window.partitionBy("doc_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    open_row = F.last(F.when(F.col("_data"), F.col("n")), ignorenulls=True).over(w)
    last_total = F.last(F.when(F.col("_total"), F.col("n")), ignorenulls=True).over(w)
    numbers = ~F.col("_data") & F.size("cells").between(1, 2) & F.forall("cells", lambda c: X.is_number(c))
    totals = g.withColumn("_open", open_row).withColumn("_t", last_total).where(numbers & F.col("_t").isNotNull() & F.col("_open").isNotNull())
    totals = totals.groupBy("doc_id", "_open", "_t").agg(F.min_by("cells", "n").alias("_c")).groupBy("doc_id", F.col("_open").alias("n")).agg(F.max_by("_c", "_t").alias("_c"))
    rows = rows.join(totals, ["doc_id", "n"], "left")
    v, p = X.decimal_literal("volume_raw"), X.decimal_literal("price_raw")
    ev = rows.groupBy("doc_id", "source_order", *GRID_COLUMNS[:5]).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "volume_raw", "price_raw", "currency_raw"))), lambda s: F.struct(s["volume_raw"].alias("volume_raw"), s["price_raw"].alias("price_raw"), s["currency_raw"].alias("currency_raw"))).alias("executions"),
        F.max("_c").alias("_c"), F.sum(v.cast("decimal(28,6)")).alias("_cv"), F.sum((v.cast("decimal(18,6)") * p.cast("decimal(18,6)")).cast("decimal(38,12)")).alias("_cn"), F.countDistinct("currency_raw").alias("_k"), F.count_if(v.isNull() | p.isNull()).alias("_bad"),
    )
    ok = (F.col("_k") == 1) & (F.col("_bad") == 0)
    dv, dp = X.decimal_literal(F.get("_c", F.lit(0))), X.decimal_literal(F.get("_c", F.lit(1)))
    ev = ev.withColumn("computed_volume", F.when(ok, F.col("_cv"))).withColumn("computed_vwap", F.when(ok & (F.col("_cv") != 0), (F.col("_cn") / F.col("_cv")).cast("decimal(38,10)")))
    volume = A.declared_qa(dv, F.col("computed_volume"), F.lit(0))
    price_ok = dp.isNull() | F.col("computed_vwap").isNull() | (F.abs(F.col("computed_vwap") - dp) <= X.half_ulp(F.get("_c", F.lit(1))))
    qa = F.when(~ok, "NOT_COMPUTABLE").when(F.col("_c").isNull(), "NO_DECLARED_AGGREGATE").when((volume == "MATCH") & price_ok, "MATCH").otherwise("DIVERGENT")
    return ev.select(
        "doc_id", "source_order", *GRID_COLUMNS[:5], X.iso_date_text("transaction_date_raw").alias("transaction_date"), X.nature("transaction_nature_raw").alias("transaction_nature_normalized"), X.outside_venue("venue_raw").alias("outside_trading_venue"),
        "executions", F.get("_c", F.lit(0)).alias("declared_aggregate_volume"), F.get("_c", F.lit(1)).alias("declared_aggregate_price"), "computed_volume", "computed_vwap", qa.alias("aggregate_qa"),
    )


def parse_status(lines: DataFrame, headers: DataFrame, events: DataFrame) -> DataFrame:
    """(doc_id, parse_status): PARSED, PARSED_WITH_UNMAPPED_VALUES where something expected is missing, UNSUPPORTED_TEMPLATE without a grid."""
    has = lines.groupBy("doc_id").agg(F.max(F.col("text").rlike(GRID_BEGIN)).alias("_grid"))
    n = events.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    d = has.join(headers, "doc_id", "left").join(n, "doc_id", "left")
    unmapped = F.col("notifying_party_name_raw").isNull() | (F.col("closely_associated") == "UNKNOWN") | (F.col("notification_kind") == "UNKNOWN") | F.col("_n").isNull()
    return d.select("doc_id", F.when(~F.col("_grid"), "UNSUPPORTED_TEMPLATE").when(F.coalesce(unmapped, F.lit(True)), "PARSED_WITH_UNMAPPED_VALUES").otherwise("PARSED").alias("parse_status"))


def band_rows(cells: DataFrame, anchors: list[float], names: list[str], tolerance: float = 42.0) -> DataFrame:
    """Positioned cells to rows of named columns, each cell to the column whose anchor is nearest within the tolerance; cells of one column are joined."""
    c = cells.withColumn("_k", X.nearest_band(F.col("x0"), anchors, tolerance)).where("_k is not null")
    joined = lambda i: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_k") == i, F.struct("cell", "t")))), lambda s: s["t"]), " ")
    return c.groupBy("doc_id", "page", "line").agg(*[F.nullif(joined(i), F.lit("")).alias(n) for i, n in enumerate(names)])


def open_rows(rows: DataFrame, columns: list[str], closing: str) -> DataFrame:
    """Rows that wrap over lines put together: lines are gathered until one has the closing column, text columns joined, the closing one kept."""
    closes = F.col(closing).isNotNull()
    g = Q.accumulate_open(rows, ["doc_id"], ["page", "line"], closes)
    text = lambda c: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("page", "line", F.col(c).alias("v"))))), lambda s: s["v"]), " "), F.lit(""))
    return g.groupBy("doc_id", "row_group").agg(*[text(c).alias(c) for c in columns]).where(F.col(closing).isNotNull())


# Columns of the treasury operations grid, from left to right, and of the holdings grid.
TREASURY_COLUMNS = ("operation_date_raw", "operation_flag_raw", "isin", "shares_direct_raw", "price_direct_raw", "shares_indirect_raw", "price_indirect_raw", "pct_raw")
HOLDING_COLUMNS = ("pct_shares_raw", "pct_instruments_raw", "pct_total_raw", "voting_rights_raw")


def treasury_operations(cells: DataFrame, anchors: list[float]) -> DataFrame:
    """Declared operations of the treasury form: rows with a date and a flag, literals beside their exact values."""
    r = band_rows(cells, anchors, list(TREASURY_COLUMNS))
    r = r.where(F.col("operation_date_raw").rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$") & F.col("operation_flag_raw").isin("A", "T"))
    w = Window.partitionBy("doc_id").orderBy("page", "line")
    return r.select("doc_id", (F.row_number().over(w) - 1).alias("row_index"), *TREASURY_COLUMNS, X.date_literal("operation_date_raw").alias("operation_date"), X.operation_flag("operation_flag_raw").alias("operation_flag_normalized"),
                    X.integer_literal("shares_direct_raw").alias("shares_direct"), X.decimal_literal("price_direct_raw").alias("price_direct"), X.integer_literal("shares_indirect_raw").alias("shares_indirect"), X.decimal_literal("price_indirect_raw").alias("price_indirect"))


def holding_positions(cells: DataFrame, lines: DataFrame, anchors: list[float], label: str) -> DataFrame:
    """The position row behind a label on the holdings form, with the agreement of its parts."""
    at = lines.where(F.col("text").rlike(label)).groupBy("doc_id").agg(F.min("n").alias("n"))
    w = Window.partitionBy("doc_id").orderBy("page", "line")
    rows = band_rows(cells, anchors, list(HOLDING_COLUMNS), 30.0)
    numbered = cells.select("doc_id", "page", "line").distinct().withColumn("n", F.row_number().over(w) - 1)
    here = rows.join(numbered, ["doc_id", "page", "line"]).join(at, ["doc_id", "n"])
    s, i, t = (X.decimal_literal(c) for c in HOLDING_COLUMNS[:3])
    return here.select("doc_id", *HOLDING_COLUMNS, s.alias("pct_shares"), i.alias("pct_instruments"), t.alias("pct_total"), X.integer_literal("voting_rights_raw").alias("voting_rights"), A.position_qa(s, i, t, X.half_ulp("pct_total_raw")).alias("aggregate_qa"))

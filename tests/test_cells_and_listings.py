"""Grids, cells and listing pages, all made here: a transaction form is written from a description of its trades."""

import pytest

from chronofold.operators import cells as C
from chronofold.sources import listings as L

LINES = "doc_id string, page int, line int, cell int, t string"
CELLS = "doc_id string, page int, line int, cell int, x0 double, x1 double, t string"


def form(spark, trades, *, party="Zubiri Ansola, Koldo", associated=False, kind="Modificación de la anterior", doc_id="n7"):
    """trades: (isin, day, nature, venue, [(volume, price)], declared); declared is None or the cells of the total's line."""
    lines = [["Name and surname"], [party], ["[" + " x"[not associated] + "] Person discharging managerial duties"], ["[" + " x"[associated] + "] Person closely related"], ["Job title"], ["Consejero coordinador"], ["Initial Notification"], [kind]]
    lines += [["a) Identificación"], ["Astilleros Pisuerga"], ["LEI:"], ["95980020140005000XX1"], ["DETAILS OF THE TRANSACTIONS"]]
    for isin, day, nature, venue, executions, declared in trades:
        lines += [[isin, "Derecho", nature, day, venue, v, p, "GBP"] for v, p in executions]
        if declared:
            lines += [["Total Agregado"], declared]
    lines += [["Additional information"], ["GB9", "Derecho", "Venta", "09/09/2019", "XLON", "9,00", "9,00", "GBP"]]
    return C.lines_of(spark.createDataFrame([(doc_id, k // 9, k % 9, j, t) for k, l in enumerate(lines) for j, t in enumerate(l)], LINES))


def read(spark, trades):
    return sorted((r.asDict(True) for r in C.grid_events(form(spark, trades)).collect()), key=lambda r: r["source_order"])


@pytest.mark.parametrize("declared, verdict", [(["41,00", "7,61"], "MATCH"), (["41,00", "7,6098"], "MATCH"), (["41,00", "7,70"], "DIVERGENT"), (["40,00", "7,61"], "DIVERGENT"), (["41,00"], "MATCH"), (None, "NO_DECLARED_AGGREGATE")])
def test_two_executions_against_what_was_declared(spark, declared, verdict):
    # (16 x 7.00 + 25 x 8.00) / 41 = 7.6097...
    (t,) = read(spark, [("GB1", "17/04/2019", "Venta", "XLON", [("16,00", "7,00"), ("25,00", "8,00")], declared)])
    assert (t["aggregate_qa"], float(t["computed_volume"]), [e["volume_raw"] for e in t["executions"]]) == (verdict, 41.0, ["16,00", "25,00"])


def test_totals_behind_other_lines_belong_to_the_trade_above(spark):
    first, second = read(spark, [("GB1", "17/04/2019", "Venta", "XLON", [("3,00", "2,00")], ["3,00", "2,00"]), ("GB1", "18/04/2019", "Compra", "XOFF", [("5,00", "2,50")], ["4,00", "2,50"])])
    assert (first["aggregate_qa"], first["transaction_nature_normalized"], first["outside_trading_venue"], first["transaction_date"]) == ("MATCH", "SELL", "FALSE", "2019-04-17")
    assert (second["aggregate_qa"], second["transaction_nature_normalized"], second["outside_trading_venue"]) == ("DIVERGENT", "BUY", "TRUE")


def test_equal_trades_that_are_not_neighbours_stay_apart(spark):
    day = ("GB1", "17/04/2019", "Compra", "XLON")
    got = read(spark, [(*day, [("1,00", "1,00")], None), ("GB1", "17/04/2019", "Donación", "??", [("2,00", "0,00")], None), (*day, [("4,00", "1,00")], None)])
    assert [float(t["computed_volume"]) for t in got] == [1.0, 2.0, 4.0]
    assert (got[1]["transaction_nature_normalized"], got[1]["outside_trading_venue"]) == (None, "UNKNOWN")


def test_headers_tell_who_and_whether_it_could_be_read(spark):
    trade = [("GB1", "17/04/2019", "Venta", "XLON", [("1,00", "1,00")], None)]
    lines = form(spark, trade, party="Inversiones Ansola S.L.", associated=True)
    h = C.form_headers(lines).first()
    assert (h["closely_associated"], h["notification_kind"], h["issuer_name_document"], h["issuer_lei_document"]) == ("TRUE", "AMENDMENT", "Astilleros Pisuerga", "95980020140005000XX1")
    assert h["notifying_party_kind"] != "NATURAL_PERSON"
    status = lambda x: C.parse_status(x, C.form_headers(x), C.grid_events(x)).first()[1]
    assert status(lines) == "PARSED" and status(form(spark, trade, kind="?")) == "PARSED_WITH_UNMAPPED_VALUES" and status(form(spark, [])) == "PARSED_WITH_UNMAPPED_VALUES"
    assert status(C.lines_of(spark.createDataFrame([("z", 0, 0, 0, "Acta de la junta")], LINES))) == "UNSUPPORTED_TEMPLATE"


def test_characters_become_cells(spark):
    def typed(text, x, y, page=0):
        return [("c", page, x + 6.0 * k, x + 6.0 * k + 5.5, y, ch) for k, ch in enumerate(text)]

    chars = typed("IV", 300, 512.0) + typed("uno", 20, 512.6) + typed("dos", 60, 511.9) + typed("abajo", 20, 498.0) + typed("otra", 20, 800.0, page=1)
    got = C.cells_from_characters(spark.createDataFrame(chars, "doc_id string, page int, x0 double, x1 double, y double, ch string"))
    assert sorted((r["page"], r["line"], r["cell"], r["t"]) for r in got.collect()) == [(0, 0, 0, "uno"), (0, 0, 1, "dos"), (0, 0, 2, "IV"), (0, 1, 0, "abajo"), (1, 0, 0, "otra")]


def test_rows_in_column_bands(spark):
    bands = [55.0 + 71.0 * k for k in range(8)]

    def row(line, **by_column):
        return [("o", 0, line, k, bands[k] + 9.0, 0.0, by_column[c]) for k, c in enumerate(C.TREASURY_COLUMNS) if c in by_column]

    grid = row(3, operation_date_raw="Día", operation_flag_raw="Signo") + row(4, operation_date_raw="21/12/2020", operation_flag_raw="T", isin="GB1", shares_indirect_raw="3.600", price_indirect_raw="0,87")
    grid += row(5, operation_date_raw="22/12/2020", operation_flag_raw="A", shares_direct_raw="41", price_direct_raw="0,9")
    got = C.treasury_operations(spark.createDataFrame(grid, CELLS), bands).orderBy("row_index").collect()
    assert [(r["operation_flag_normalized"], r["shares_direct"], r["shares_indirect"]) for r in got] == [("DISPOSAL", None, 3600), ("ACQUISITION", 41, None)]
    cells = spark.createDataFrame([("h", 2, 0, 0, 15.0, 0.0, "Total atribuido")] + [("h", 2, 0, k + 1, x, 0.0, t) for k, (x, t) in enumerate(zip((250.0, 330.0, 415.0, 501.0), ("2,25", "0,75", "3,10", "64.000")))], CELLS)
    p = C.holding_positions(cells, C.lines_of(cells), [250.0, 330.0, 415.0, 501.0], "Total atribuido").first()
    assert (p["voting_rights"], p["aggregate_qa"]) == (64000, "DECLARED_COMPUTED_MISMATCH")


def test_wrapped_rows_end_with_their_closing_column(spark, rows):
    lines = spark.createDataFrame([("d", 0, 0, "Caja Rural", None), ("d", 0, 1, "del Bierzo", None), ("d", 1, 0, None, "61,2"), ("d", 1, 1, "Vda. de Loureiro", "0,4"), ("d", 1, 2, "sin final", None)], "doc_id string, page int, line int, name string, pct string")
    assert rows(C.open_rows(lines, ["name", "pct"], "pct"), "name", "pct") == [("Caja Rural del Bierzo", "61,2"), ("Vda. de Loureiro", "0,4")]


def entry(k, body, nif="W-55", day="03/02/2021"):
    return f'<div id="repListaPrincipal_ctl{k:02d}_elementoPrimerNivel"><i class="liFechaRegistro">{day}</i><a href="../datosentidad.aspx?nif={nif}">f</a>{body}</div>'


def test_blocks_of_a_listing(spark, rows):
    html = entry(0, "Declarante: O&#39;Shea &amp; Cía<br>Número de registro: 5550007 rectificada por nº de registro: 5550009 <a href='verdocumento/ver?e=q9'>pdf</a>") + entry(1, "Número de registro: 5550008", nif="X1", day="30/02/2021") + entry(2, "sin número")
    n = L.listing_notices(spark.createDataFrame([("https://x.invalid/1", html)], "url string, html string")).cache()
    assert rows(n, "notice_key", "notice_status", "doc_token") == [("nod:5550007", "RECTIFIED", "q9"), ("nod:5550008", "ACTIVE", None)]
    assert [r[0] for r in n.where("filing_date is null").select("notice_key").collect()] == ["nod:5550008"]
    assert rows(L.listing_relations(n), "annulling_key", "annulled_key", "relation_type") == [("nod:5550009", "nod:5550007", "RECTIFIES")]
    inside, outside = L.split_by_universe(n, spark.createDataFrame([("astilleros", "W55")], "issuer_id string, nif string"))
    assert rows(inside, "notice_key", "issuer_id") == [("nod:5550007", "astilleros")] and rows(outside) == [("X1",)]


def test_other_pages(spark, rows):
    def page(html):
        return spark.createDataFrame([("p", html), ("q", "<em>vacía</em>")], "url string, html string")

    table = "<table class=t id=gridNotifAnt><tr><th>a</th></tr><tr><td>3,99</td><td>Abrir PDF de 4440001</td></tr><tr><td>x</td><td>Abrir PDF de 444000112</td><td>07/07/2014</td><td><a href=verdocumento/ver?e=k2>v</a></td></tr></table>"
    assert [(r["notice_key"], r["filing_date"].isoformat()) for r in L.history_rows(page(table), "ac").collect()] == [("ac:444000112", "2014-07-07")]
    said = "<p>El registro de entrada 777000111 anula las comunicaciones 666000222 de 01/01/2013 y 666000333 de 02/01/2013</p>"
    assert rows(L.annulment_statements(page(said), "ps"), "annulling_key", "annulled_key") == [("ps:777000111", "ps:666000222"), ("ps:777000111", "ps:666000333")]
    assert rows(L.issuer_identity(page("<td data-th='NIF'>W55</td><td data-th='Capital social vigente'>1.200,5</td>")), "nif", "lei", "capital_raw") == [("W55", None, "1.200,5")]
    assert rows(L.recent_issuers(page("ps_ac_ini.aspx?nif=W55 ps_ac_ini.aspx?nif=X1 ps_ac_ini.aspx?nif=W55"))) == [("W55",), ("X1",)]
    assert rows(L.query_links(page("Derechos.aspx?qS={a1} Otra.aspx?qS={b2} Derechos.aspx?qS={a1}"), "Derechos"), "link") == [("Derechos.aspx?qS=%7Ba1%7D",)]

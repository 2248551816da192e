"""The two forms by documents made here: a builder places cells in columns, each test states a form of its own."""

from decimal import Decimal

import pytest

from chronofold.operators import forms

#: Where the columns of the made documents begin; headings and numbers of one column share it, give or take a few points.
EIGHT = (140.0, 205.0, 262.0, 330.0, 395.0, 451.0, 512.0, 577.0)
FOUR = (221.0, 309.0, 402.0, 488.0)


class Form:
    """Lines of cells on pages. put() takes texts at the left edge, or (text, x) pairs."""

    def __init__(self, doc_id="doc"):
        self.doc_id, self.rows, self.page, self.line = doc_id, [], 0, 0

    def put(self, *cells):
        for k, c in enumerate(cells):
            t, x = c if isinstance(c, tuple) else (c, 12.0 + 90.0 * k)
            self.rows.append((self.doc_id, self.page, self.line, k, float(x), float(x) + 5.0 * len(t), t))
        self.line += 1
        return self

    def turn(self):
        self.page, self.line = self.page + 1, 0
        return self

    def frame(self, spark):
        return spark.createDataFrame(self.rows, "doc_id string, page int, line int, cell int, x0 double, x1 double, t string")


def at(columns, *pairs):
    return [(t, columns[k] + (k % 3)) for k, t in pairs]


def own_shares(declared_sold="7.150", headings=True):
    f = Form().put("Comunicación sobre acciones propias").put("Denominación social del emisor").put("Lanificios Brunete S.L.")
    f.put("[ x ] Primera admisión").put("[  ] Umbral del 1 % de adquisiciones").put("[ √ ] Actualización sobrevenida").put("Fecha que motiva la notificación").put("09/11/2022")
    f.put("4. Detalle de las operaciones efectuadas")
    if headings:
        f.put(*at(EIGHT, *enumerate(("Directas", "Precio", "Indirectas", "Precio", "Directos", "Indirectos", "Directos", "Indirectos"))))
    f.put(("02/11/2022", 8), ("T", 66), ("ES0600000024", 80), *at(EIGHT, (0, "7.150"), (1, "3,0825"), (4, "7.150"), (6, "0,017")))
    f.turn()
    f.put(("03/11/2022", 8), ("A", 66), ("ES0600000024", 80), *at(EIGHT, (2, "912"), (3, "3,11"), (5, "912"), (7, "0,002")))
    f.put(("04/11/2022", 8), ("A", 66), ("ES0600000024", 80), *at(EIGHT, (0, "88"), (1, "3,2"), (2, "12"), (3, "3,2"), (4, "88"), (5, "12")))
    f.put(("Total adquisiciones", 8), *at(EIGHT, (4, "88"), (5, "924"))).put(("Total transmisiones", 8), *at(EIGHT, (4, declared_sold)))
    f.put("5. Posesión final").put(*at(EIGHT, *enumerate(("Directas", "Indirectas", "Directos", "Indirectos", "Total", "Directos", "Indirectos", "Total"))))
    f.put(("ES0600000024", 80), *at(EIGHT, (0, "40.210"), (1, "924"), (2, "40.210"), (3, "924"), (4, "41.134"), (5, "0,096"), (6, "0,002"), (7, "0,098")))
    return f.put("6. Identificación de terceros")


def test_operations_of_two_pages_and_their_totals(spark):
    head, ops, final = forms.treasury_form(own_shares().frame(spark))
    h = head.first()
    assert (h["issuer_name_document"], h["notification_date"].isoformat()) == ("Lanificios Brunete S.L.", "2022-11-09")
    assert [h[k] for k in ("reason_first_admission", "reason_acquisitions_1pct", "reason_voting_rights_update")] == [True, False, True]
    assert (h["acquisitions_qa"], h["transmissions_qa"]) == ("MATCH", "MATCH")
    got = {r["row_index"]: r for r in ops.collect()}
    assert [got[k]["operation_flag_normalized"] for k in range(3)] == ["DISPOSAL", "ACQUISITION", "ACQUISITION"]
    assert (got[0]["shares_direct"], got[0]["price_direct"], got[0]["shares_indirect"]) == (7150, Decimal("3.0825000000"), None)
    assert (got[1]["shares_direct"], got[1]["shares_indirect"], got[1]["vr_indirect"]) == (None, 912, 912)
    assert (got[2]["shares_direct"], got[2]["shares_indirect"], got[2]["pct_direct"]) == (88, 12, None)
    (end,) = final.collect()
    assert [end[c] for c in ("shares_direct", "shares_indirect", "vr_total")] == [40210, 924, 41134] and end["pct_total"] == Decimal("0.0980000000")


def test_a_side_that_does_not_add_up_leaves_the_other_alone(spark):
    h = forms.treasury_form(own_shares(declared_sold="7.151").frame(spark))[0].first()
    assert (h["acquisitions_qa"], h["transmissions_qa"], h["transmissions_vr_direct"]) == ("MATCH", "DIVERGENT", 7151)


def test_without_headings_no_number_is_guessed(spark):
    _, ops, final = forms.treasury_form(own_shares(headings=False).frame(spark))
    assert {r["shares_direct"] for r in ops.collect()} == {None} and final.count() == 1


def stake(shares="12,041", instruments="1,337", total="13,378"):
    f = Form("stake").put("1. Identificación del emisor de las acciones").put("Cementos Odiel y Cía").put("[ ] Adquisición o transmisión de derechos de voto").put("[ v ] Adquisición o transmisión de instrumentos financieros")
    f.put("Apellidos y nombre o denominación").put("Fundación Ribalta").put("Ciudad y país del domicilio").put("GIJÓN, ESPAÑA").put("Fecha en la que se cruzó").put("28/02/2017")
    f.put("6. Situación resultante").put((shares, 200), (instruments, 280), (total, 360), ("8.004.119", 440)).put("Posición de la notificación anterior").put(("9,900", 200), ("0,412", 280), ("10,312", 360))
    f.turn().put("7.A acciones").put(*at(FOUR, *enumerate(("Directo", "Indirecto", "Directo", "Indirecto"))))
    f.put(("ES0600000016", 20), *at(FOUR, (1, "700.001"), (3, "8,745"))).put(("ES0600000032", 20), *at(FOUR, (0, "263.800"), (2, "3,296"))).put("Subtotal 7.A")
    return f.put("7.B.1 instrumentos").put("Permuta", "30/06/2018", "107.015", "1,337").put("Subtotal 7.B.1")


def test_holdings_of_two_share_classes(spark):
    head, shares, instruments = forms.holdings_form(stake().frame(spark))
    h = head.first()
    assert (h["obliged_subject_name_raw"], h["obliged_subject_residence_raw"], h["threshold_date"].isoformat(), h["issuer_total_voting_rights"]) == ("Fundación Ribalta", "GIJÓN, ESPAÑA", "2017-02-28", 8004119)
    assert (h["reason_voting_rights"], h["reason_instruments"]) == (False, True) and h["position_previous"] == ["9,900", "0,412", "10,312"]
    by = {r["isin"]: r for r in shares.collect()}
    assert (by["ES0600000016"]["vr_direct"], by["ES0600000016"]["vr_indirect"], by["ES0600000032"]["vr_direct"]) == (None, 700001, 263800)
    assert by["ES0600000032"]["pct_direct"] == Decimal("3.2960000000")
    (i,) = instruments.collect()
    assert (i["instrument_type_raw"], i["voting_rights"], i["expiration_date"].isoformat()) == ("Permuta", 107015, "2018-06-30")


@pytest.mark.parametrize("total, verdict", [("13,378", "DECLARED_COMPUTED_MATCH"), ("13,3784", "DECLARED_COMPUTED_MISMATCH"), ("13,4", "DECLARED_COMPUTED_MATCH")])
def test_the_total_agrees_within_half_its_last_place(spark, total, verdict):
    assert forms.holdings_form(stake(total=total).frame(spark))[0].first()["aggregate_qa"] == verdict


def test_what_is_no_such_form_has_a_header_and_no_rows(spark):
    letter = Form("letter").put("Estimados señores:").put("adjuntamos copia")
    for read in (forms.treasury_form, forms.holdings_form):
        head, *children = read(letter.frame(spark))
        assert [r["doc_id"] for r in head.collect()] == ["letter"] and [c.count() for c in children] == [0, 0]
        assert [x.count() for x in read(letter.frame(spark).limit(0))] == [0, 0, 0]

import pytest

from chronofold.llm import encoding as E

ES = ["El consejo de administración tomó razón de la transmisión el 4 de agosto de 2022 y acordó su publicación sin demora. ", "La entidad comunica que, según la información facilitada por el emisor, la posición final en autocartera asciende a 1.234 títulos. ", "Durante el año se realizaron operaciones de compra, todas ellas dentro del límite del 5 %. ", "¿Existe acuerdo de acción concertada? No, según el depositario. ", "Así lo ratificó la comisión en su sesión, añadiéndose únicamente la firma del representante. ", "El préstamo de valores vence el próximo año; la cuantía figura en el epígrafe de instrumentos. "]
EN = ["The weighted average price was reported by the custodian on the first day of the month. ", "Shareholders’ agreements were not amended – no voting instructions are recorded. ", "The issuer, according to the file, cancelled 1,234 shares; the signature page was scanned at low resolution. "]
DE = ["Die Gesellschaft teilt mit, dass die Schwelle überschritten wurde; für eigene Aktien ergibt sich ein Anteil. ", "Größe und Ausübungszeitraum der Optionen sind in Anlage 2 aufgeführt. "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(10 * i + j, "".join(x[(i + k) % len(x)].replace("1.234", str(i * 7 + k)) for k in range(6)), lang, "x") for i in range(120) for j, (lang, x) in enumerate((("es", ES), ("en", EN), ("de", DE)))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, restored string").cache()


@pytest.fixture(scope="module")
def dictionaries(docs):
    return E.train_dictionaries(docs)


@pytest.fixture(scope="module")
def judge(dictionaries):
    return E.Judge(dictionaries)


CHAINS = {
    "utf8 as cp1252": lambda t: "".join(chr(b) if b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode("cp1252") for b in t.encode()), "utf8 as latin1": lambda t: t.encode().decode("latin1"), "utf8 as mac": lambda t: t.encode().decode("mac_roman"), "utf8 as cp437": lambda t: t.encode().decode("cp437"), "utf8 as cp850": lambda t: t.encode().decode("cp850"),
    "cp1252 as mac": lambda t: t.encode("cp1252").decode("mac_roman"), "cp1252 as cp437": lambda t: t.encode("cp1252").decode("cp437"), "cp1252 as cp1251": lambda t: t.encode("cp1252").decode("cp1251"), "twice": lambda t: t.encode().decode("latin1").encode().decode("latin1"), "utf16": lambda t: (t if len(t) % 2 == 0 else t + " ").encode("cp1252").decode("utf-16-le"),
}


@pytest.mark.parametrize("chain", CHAINS)
def test_round_trip(judge, chain):
    clean = ES[0] + ES[2] + ES[4]
    status, fixed, chains, n = E.restore(CHAINS[chain](clean), judge, "es")
    assert status == "RESTORED" and n and chains
    assert fixed.strip() == clean.strip()


@pytest.mark.parametrize("lang", ["es", None, "de"])  # the language told may be wrong
def test_garbled_in_places_only(judge, lang):
    text = ES[0] + CHAINS["utf8 as cp1252"](ES[3]) + ES[2]
    assert E.restore(text, judge, lang)[:2] == ("RESTORED", ES[0] + ES[3] + ES[2])


@pytest.mark.parametrize("text", [
    "", "plain", ES[0] + "Ångström Œuvre Ÿser Ðelta (lista de caracteres). " + ES[2], ES[2] + "Tolerancia ±0,005 %. ½ acción por cada 10. ©2024. ", "añadiéndose únicamente la posición ", ES[0].replace("ó", "o"),
    "NEGOCIAÇÃO FORA DE MERCADO: NÃO HÁ RELAÇÃO COM PLANO DE OPÇÕES.", "x­-­ref​ interna", DE[1], "&eacute; <b>marcado</b> &nbsp;",
])
def test_intended_characters_stay(judge, text):
    assert E.restore(text, judge, "es")[:2] == ("CLEAN", text)


def test_lost_bytes_are_found_and_not_invented(judge):
    assert E.restore("Tecnolog�a, S.A.", judge, "es")[:2] == ("UNRESTORABLE", "Tecnolog�a, S.A.")


def test_repair_of_a_table(spark, dictionaries, rows):
    bad = CHAINS["utf8 as cp1252"](ES[0])
    long = ES[1] * 400 + bad + ES[1] * 400
    df = spark.createDataFrame([(1, bad, "es", "clash"), (2, ES[0], "es", None), (3, None, "es", None), (4, "", None, None), (None, bad, "es", None), (5, long, None, None)], "doc_id bigint, text string, lang string, status string")
    got = {r["doc_id"]: r for r in E.repair(df, dictionaries).collect()}
    assert set(got) == {1, 5} and got[1]["restored"] == ES[0] and got[5]["restored"] == ES[1] * 400 + ES[0] + ES[1] * 400
    assert E.repair(df.limit(0), dictionaries).count() == 0


def test_training_takes_no_garbled_documents_and_survives_none(spark, docs):
    assert E.train_dictionaries(docs.limit(0)) == {}
    assert E.train_dictionaries(spark.createDataFrame([(1, "t", "xx")], "doc_id bigint, text string, lang string")) == {}
    assert E.restore("presentÃ³ fuera de plazo", E.Judge({}), None)[:2] == ("RESTORED", "presentó fuera de plazo")


def test_gate_is_the_same_in_both_engines(spark):
    import re

    texts = []
    for t in ES + EN + DE:
        for c in (*CHAINS.values(), str):
            try:
                texts.append(c(t))
            except UnicodeError:  # some bytes of this text aren't defined there
                continue
    texts += ["ok", "col·lectiva", "Größe", "formaliz¾", "�", "Energφa", "PARTICIPACI”N"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r[0] for r in df.where(E.is_suspicious("t")).select("i").collect()}
    assert got == {i for i, t in enumerate(texts) if re.search(E.SUSPICIOUS, t)}


@pytest.mark.parametrize("good, bad, lang, word", [("á", "ß", "es", "El cálculo del importe está en el anexo del informe. "), ("ä", "õ", "de", "Die geänderten Anteile werden später gemeldet. ")])
def test_ordinary_letters_of_other_languages(spark, good, bad, lang, word):
    x = {"es": ES, "de": DE}[lang]
    train = spark.createDataFrame([(i, word + x[i % len(x)] + word.replace(".", f" {i}."), lang) for i in range(300)], "doc_id bigint, text string, lang string")
    dictionaries = E.train_dictionaries(train)
    clean = x[0] + word
    text = x[0] + word.replace(good, bad)
    df = spark.createDataFrame([(1, text, lang), (2, clean, lang)], "doc_id bigint, text string, lang string")
    got = E.repair(df, dictionaries).collect()
    assert [(r["doc_id"], r["restored"]) for r in got] == [(1, clean)]


def misread(text, written, read):
    """Bytes of one encoding read in another; bytes that it leaves undefined become the control of that number."""
    return "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in text.encode(written))


@pytest.mark.parametrize("written, read, times", [("utf-8", "cp1252", 1), ("utf-8", "mac_roman", 1), ("utf-8", "cp437", 1), ("utf-8", "cp1252", 2), ("utf-8", "cp1252", 4), ("cp1252", "cp437", 1), ("cp1252", "cp1251", 1), ("cp850", "cp1252", 1)])
def test_made_garbles_are_restored_exactly(judge, written, read, times):
    text, bad = ES[0] + ES[1] + ES[4], ES[0]
    for _ in range(times):
        bad = misread(bad, written, read)
    status, fixed, chains, n = E.restore(bad + ES[1] + ES[4], judge, "es")
    assert (status, fixed, n) == ("RESTORED", text, 1), chains


def test_every_reading_may_be_measured(judge, dictionaries):
    """Readings that explain nothing odd change no clean text either."""
    every = E.Judge(dictionaries, every=True)
    for t in ES + ["Temperatura 21 °C, 1ª hoja, «anexo»."]:
        assert E.restore(t, every, "es")[0] == E.restore(t, judge, "es")[0] == "CLEAN"
    assert E.restore(misread(ES[0], "cp1252", "cp437"), every, "es")[1] == ES[0]


def test_every_single_byte_reading_is_measured(dictionaries):
    judge, measured = E.Judge(dictionaries), set()
    bits = judge.bits
    judge.bits = lambda t, *more: measured.add(t) or bits(t, *more)
    bad = misread(ES[0], "cp1252", "cp437")
    assert judge.best(bad, {"es"}, set())[0] == ES[0]
    chars = frozenset(E._HIGH.findall(bad))
    alien = lambda t: len(E._ALIEN.findall(t))
    readings = {"".join(made.get(c, c) for c in bad) for _, made in E._singles(chars)}
    assert len(readings) > 5 and {r for r in readings if alien(r) <= alien(bad)} <= measured


def test_a_reading_that_explains_nothing_odd_wins_if_it_is_much_shorter(judge):
    """Letters that French uses, beside a character that is out of place under any reading."""
    text = "Ŧelta: " + ES[0]
    bad = text.replace("ó", "ù")  # written by a Mac, read as cp437
    assert len(E._SUSPECT.findall(bad)) == len(E._SUSPECT.findall(text)) > 0
    assert judge.best(bad, {"es", "fr"}, set()) == (text, "mac_roman<cp437")
    assert judge.best(text, {"es", "fr"}, set()) == (text, "")

import pytest

from chronofold.llm import names as N

GROUPS = [
    ["Juan Carlos Grosendo Brirtonza", "JUAN CARLOS GROOSENDO Y BRIRTONZA", "Grosendo Brirtonza, Juan Carlos", "Juancar Grosendo Brirtonza", "D. J. C. Grosendo-Brirtonza", "juan carlos grosendo b.", "Grosendo Brirtonza J. C."],
    ["María Grosendo Brirtonza", "Mª Grosendo Brirtonza", "DÑA. MARIA GROSENDO BRIRTONZA"],
    ["Francisco Fabutés Fimaña", "Paco Fabutes Fimana", "FABUTÉS FIMAÑA, FRANCISCO", "Fco. de Fabutés Fimaña", "F. Fabutés Fimaña ", "Francisco Fabutés", "Frncisco Fabtés Fimaña"],
    ["Sadetés Internacional, G.m.b.H.", "Internacional Sadetes GmbH", "SADETÉS INTL."],
    ["Investment Fund Meroria & Sedundo, S.A.", "Meroria and Sedundo Inv. Fd., S. A.", "MERORIA Y SEDUNDO INVESTMENT FUND Sociedad Anónima", "Investment Fund Merorria & Sedundo, S.A."],
    ["Meroria & Sedundo Navieras, S.A.", "Nav. Meroria y Sedundo"],
    ["Meroria & Sedundo Navieras II, S.A.", "MERORIA & SEDUNDO NAVIERAS II"],
    ["Asset Management Luroña, Inc.", "A.M. Luroña, Incorporated", "AM LUROÑA INC"],
]


@pytest.fixture(scope="module")
def linked(spark):
    rows = [(n, 3 if k == 0 else 1, "clash") for g in GROUPS for k, n in enumerate(g)] + [(None, 4, None), ("", 1, None), ("   ", 1, None), ("?", 2, None)]
    # words of other declarants, so that the right spellings are the common ones
    rows += [(f"{g} {s} Otrolo{c}", 2, None) for g in ("Ana", "Pablo") for s in ("Grosendo", "Brirtonza", "Fabutés", "Fimaña", "Meroria", "Sedundo") for c in "abc"]
    return N.link_variants(spark.createDataFrame(rows, "name string, n int, entity string")).cache()


def test_variants_are_linked_and_relatives_are_not(linked):
    ent = {r["name"]: r["entity"] for r in linked.collect()}
    for g in GROUPS:
        assert len({ent.get(n) for n in g}) == 1 and ent.get(g[0]), [(n, ent.get(n)) for n in g]
    assert len({ent[g[0]] for g in GROUPS}) == len(GROUPS)


def test_pairs_are_ordered_and_complete(linked):
    pairs = {(r["name_a"], r["name_b"]) for r in N.variant_pairs(linked).collect()}
    assert all(a < b for a, b in pairs)
    for g in GROUPS:
        assert {(min(a, b), max(a, b)) for a in g for b in g if a != b} <= pairs


def test_ambiguous_initials_link_to_nobody(spark):
    df = spark.createDataFrame([("José Rilora Cambal", 2), ("Juan Rilora Cambal", 2), ("J. Rilora Cambal", 1)], "name string, n int")
    ent = {r["name"]: r["entity"] for r in N.link_variants(df).collect()}
    assert ent["J. Rilora Cambal"] not in (ent["José Rilora Cambal"], ent["Juan Rilora Cambal"])


def test_empty_and_very_long(spark):
    empty = spark.createDataFrame([], "name string, n int")
    assert N.link_variants(empty).count() == 0 and N.variant_pairs(N.link_variants(empty)).count() == 0
    assert N.link_variants(spark.createDataFrame([("x" * 5000, 1), (None, 1)], "name string, n int")).count() <= 1


def test_parts():
    assert N.tokens_of("D.ª Mª  del\xa0Carmen  X-Z") == ["da", "maria", "del", "carmen", "x.", "z."]
    assert N.key_of(N.parse(N.tokens_of("Zurtités Praruros, L. A.")))[0] == "P|la.|zurtites|praruros"
    assert N.key_of(N.parse(N.tokens_of("Prerorte Cap. Partners III, B.V.")))[0] == "O|prerorte|capital partners|iii"
    assert N._distance("abcd", "abdc", 2) == 1 and N._distance("abcd", "abcd", 0) == 0 and N._distance("abcd", "wxyz", 2) == 3
    assert set(N.forms_of("P|juan carlos|a|bc")) == {"P|juan carlos|a|b.", "P|juan carlos|a|-", "P|jc.|a|bc", "P|jc.|a|b.", "P|jc.|a|-"}


def test_names_of_no_list_are_linked(spark):
    groups = [
        ["Hakan Yilmaz Demir", "HAKAN YILMAZ DEMIR", "Demir, Hakan Yilmaz"], ["Banco Norte", "BANCO NORTE", "Banco Norte, S.A."], ["Sakari Virtanen Koski", "Virtanen Koski, Sakari", "S. Virtanen Koski"],
        ["Tuulikki Nieminen Aalto", "AALTO NIEMINEN TUULIKKI", "Tuulikki Niemminen Aalto"],
    ]
    rows = [(n, 2 if k == 0 else 1) for g in groups for k, n in enumerate(g)] + [("?", 1), ("...", 1)]
    got = {r["name"]: r["entity"] for r in N.link_variants(spark.createDataFrame(rows, "name string, n int")).collect()}
    assert all(len({got.get(n) for n in g}) == 1 and got.get(g[0]) for g in groups), got
    assert len({got[g[0]] for g in groups}) == len(groups) and "?" not in got and "..." not in got


def test_legal_forms_tell_entities_apart(spark):
    typed = ["Banco Santero SA", "BANCO SANTERO S.A.", "Banco Santero, S.L.", "Banco Santero", "Navieras Olmedo, S.A.", "NAVIERAS OLMEDO", "Olmedo Navieras S. A."]
    ent = {r["name"]: r["entity"] for r in N.link_variants(spark.createDataFrame([(t, 1) for t in typed], "name string, n int")).collect()}
    assert ent["Banco Santero SA"] == ent["BANCO SANTERO S.A."]
    assert len({ent["Banco Santero SA"], ent["Banco Santero, S.L."], ent["Banco Santero"]}) == 3  # without a form it may be either
    assert len({ent[t] for t in typed[4:]}) == 1  # one form only: leaving it out doesn't count


def made_names(seed, people=150, firms=60):
    """Declarants whose words are in no list, each in several spellings: (declarant, spelling)."""
    import random

    r = random.Random(seed)
    syllable = lambda: r.choice("bdfgklmnprstvz") + r.choice("aeiou") + r.choice(["", "", "n", "r", "s", "l"])
    word = lambda k: "".join(syllable() for _ in range(k)).capitalize()
    given = sorted({word(3) for _ in range(40)} - {w.capitalize() for w in N.LEXICON})
    out, kept = [], set()
    for k in range(people):
        g, a, b = r.choice(given), word(3), word(3)
        if (a, b) in kept:
            continue
        kept.add((a, b))
        i = r.randrange(1, len(a))
        out += [(k, x) for x in (f"{g} {a} {b}", f"{g} {a} {b}".upper(), f"{a} {b}, {g}" if k % 3 else f"{a} {b} {g}", f"{a.upper()} {b.upper()} {g.upper()}", f"{g} {a[:i]}{a[i - 1]}{a[i:]} {b}")]
    for k in range(people, people + firms):
        w = f"{word(3)} {word(4)}"
        out += [(k, x) for x in (w, w.upper(), f"{w}, S.A.", f"{w} Sociedad Anónima")]
    return out


@pytest.mark.parametrize("seed", [3, 11])
def test_recall_and_precision_on_names_of_no_list(spark, seed):
    made = made_names(seed)
    ent = {r["name"]: r["entity"] for r in N.link_variants(spark.createDataFrame([(x, 1) for _, x in set(made)], "name string, n int")).collect()}
    assert set(ent) == {x for _, x in made}  # every name has a row
    by = {}
    for k, x in set(made):
        by.setdefault(k, set()).add(x)
    true = {(a, b) for s in by.values() for a in s for b in s if a < b}
    groups = {}
    for x, e in ent.items():
        groups.setdefault(e, set()).add(x)
    found = {(a, b) for s in groups.values() for a in s for b in s if a < b}
    assert len(true & found) / len(true) > 0.95 and len(true & found) / len(found) > 0.97, (len(true & found) / len(true), len(true & found) / len(found))


def test_long_chains_of_misspellings_end_at_their_root(spark):
    steps = [(f"f{k + 1}", f"f{k}") for k in range(40)]
    got = {r["wrong"]: r["form"] for r in N._followed(spark.createDataFrame(steps, "wrong string, form string")).collect()}
    assert got == {w: "f0" for w, _ in steps}


def peak_mb(work):
    import tracemalloc

    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_does_not_follow_what_long_words_and_names_make():
    words = [f"{'grosendobrirtonza' * k}{i:03d}" for k in (1, 2) for i in range(150)] + ["".join(chr(97 + i * i % 26) for i in range(700))]
    sizes = []
    rows = ((t, v, far) for t in words for v, far in N._around(t))
    assert peak_mb(lambda: sizes.extend((len(f), sum(map(len, f["t"]))) for f in N._pieces(rows, ["t", "v", "far"]))) < 60
    assert sum(n for n, _ in sizes) > 350_000 and all(n <= N.PIECE and c <= N.PIECE_CHARS + 700 for n, c in sizes)
    for w in ("xxxxxxxxx", "abababab", "aabbaccab", "grosendo"):
        assert set(N._two_deletions(w)) == N._deletions(w, 2) - N._deletions(w, 1)
    name = [f"tok{c}{d}e" for c in "abcdefgh" for d in "xyz"]
    fixes = {t: [(t + x, 1, 5) for x in "rst"] for t in name}
    got = []
    assert peak_mb(lambda: got.extend(len(p) for p in N.rewritings(["sa.", *name], fixes, 3))) < 60
    assert sum(got) == 1 + 24 * 3 + 276 * 9 + 2024 * 27 and len(got) == 3 and max(got) <= N.PIECE + 1


def test_corrections_pass_as_lines():
    assert N._told("") == ({}, frozenset())
    assert N._told("grosnedo grosendo 1 7 grosedo 2 1000000\t\nhakan\thakan hakkan\nx\t") == ({"grosnedo": [("grosendo", 1, 7), ("grosedo", 2, 1000000)]}, {"hakan", "hakkan"})


def test_two_entities_of_a_form_tell_as_much_as_all(spark):
    short = [(f"e{k}", f, k % 2) for k in range(60) for f in ("common", f"own{k}", f"pair{k // 2}")]
    full = spark.createDataFrame(short, "entity string, form string, odd int")
    two = N._two(full, "odd").cache()
    assert two.where("form = 'common'").count() == 4 and two.groupBy("form", "odd").count().where("count > 2").isEmpty()
    hits = spark.createDataFrame([("a", "common", 1), ("b", "own3", 0), ("c", "pair4", 0), ("d", "common", 1), ("d", "own7", 0), ("d", "own8", 2)], "name string, form string, cost int")
    answers = [{tuple(r) for r in N._unique(hits.join(x, "form").select("name", "entity", "cost", "odd")).collect()} for x in (full, two)]
    assert answers[0] == answers[1] == {("b", "e3"), ("c", "e8"), ("d", "e7")}

"""Variant spellings of names typed by people: canonical rewritings, equi-joins on them, and rarity as the score."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, reach_package

# Given names and the short forms people type for them.
NICKNAMES = {
    "alejandro": "alex jandro ale", "ana": "anita", "andres": "andy andresito", "antonio": "toni tono antonito ant", "beatriz": "bea beti", "bernardo": "berni nardo",
    "carlos": "carlitos charly", "carmen": "carmina carmela", "concepcion": "concha conchita", "dolores": "lola loli", "eduardo": "edu lalo edo", "elena": "nena lena", "elizabeth": "beth liz betty lizzy eli",
    "enrique": "quique kike", "esther": "tete ester", "fernando": "fer nando fdo", "francisco": "paco fran pancho curro quico fco kiko", "gabriel": "gabi", "gregorio": "goyo", "guadalupe": "lupe lupita", "hugo": "huguito",
    "ignacio": "nacho ign", "ines": "nes", "irene": "ire", "isabel": "isa chabela bel", "javier": "javi xavi", "jesus": "chus suso chuchu", "joaquin": "quino ximo", "jose": "pepe pepito", "juan": "juanito juanjo", "katherine": "kate kathy katy kat", "kevin": "kev",
    "leandro": "lea", "lucia": "lucy luci", "luis": "lucho luisito", "manuel": "manolo manu lolo mnl", "maria": "ma mari mary", "mercedes": "merche", "miguel": "migue mike", "nuria": "nuri", "oscar": "osqui", "pablo": "pablito", "rafael": "rafa", "ramon": "moncho monchi",
    "robert": "rob bob bobby", "rosario": "charo rosa", "santiago": "santi yago", "sofia": "sofi chofi", "teresa": "tere", "tomas": "tom tommy tomy", "ursula": "ursu uschi", "victor": "vic", "wanda": "wan", "william": "bill will billy", "yolanda": "yoli yola",
    "alberto": "beto", "belen": "belencita", "angel": "angelito", "pedro": "perico", "david": "", "daniel": "dani", "jorge": "", "sergio": "", "pilar": "pili", "rosa": "", "marta": "", "laura": "", "cristina": "cris", "patricia": "patri", "diego": "", "alvaro": "", "ruben": "", "raul": "", "adrian": "",
    "john": "johnny jack", "james": "jim jimmy", "michael": "mick", "richard": "dick rick", "thomas": "", "margaret": "maggie peggy", "susan": "sue", "peter": "pete", "george": "", "emma": "", "anna": "", "paul": "", "mark": "",
}
# Short forms of compound given names.
COMPOUND = {"chema": "jose maria", "josema": "jose maria", "juancar": "juan carlos", "anabel": "ana belen", "mamen": "maria carmen", "maricarmen": "maria carmen", "maica": "maria carmen", "mayte": "maria teresa", "maite": "maria teresa", "josele": "jose luis", "pepelu": "jose luis", "luisal": "luis alberto", "juanma": "juan manuel", "josean": "jose antonio", "juanca": "juan carlos", "miguelan": "miguel angel", "maritere": "maria teresa"}
# Words of address, and particles that are put in or left out.
TITLES = frozenset("don dona dna dn d da sr sra srta mr mrs ms dr dra".split())
PARTICLES = frozenset("de del la las los y e i and et und da do dos".split())
# Legal forms as typed, without dots.
LEGAL = {
    "sa": "sa", "sociedad anonima": "sa", "sl": "sl", "sociedad limitada": "sl", "slu": "sl", "sau": "sa", "ltd": "ltd", "limited": "ltd", "plc": "plc", "public limited company": "plc", "llp": "llp", "limited liability partnership": "llp", "gmbh": "gmbh",
    "bv": "bv", "nv": "nv", "inc": "inc", "incorporated": "inc", "sicav": "sicav", "se": "se", "sca": "sca", "ag": "ag", "corp": "corp", "corporation": "corp", "llc": "llc",
}
# What organisations do, and how its words are abbreviated.
ACTIVITIES = ("asset management", "capital partners", "investment fund", "servicios financieros", "holdings", "hermanos", "participaciones", "inversiones", "gestion", "valores", "cartera", "patrimonial", "internacional", "tecnologia", "logistica", "energia", "navieras", "inmobiliaria")
WORDS = {
    "asset": "ass", "management": "mgmt mgt man manag", "capital": "cap", "partners": "prnrs ptnrs ptrs part partn", "investment": "inv invest invt", "fund": "fd", "servicios": "serv svcs svc servs", "financieros": "fin financ financ", "holdings": "holding hldgs hold hldg",
    "hermanos": "hnos hnos", "participaciones": "partic participac part particip", "inversiones": "inv invers inversions", "gestion": "gest", "valores": "val", "cartera": "cart", "patrimonial": "patr patrim", "internacional": "intl internac int", "tecnologia": "tecnol tec", "logistica": "logist log",
    "energia": "energ ener", "navieras": "nav", "inmobiliaria": "inmob inmobil",
}
# What tells entities of one brand apart besides the activity.
QUALIFIERS = frozenset("i ii iii iv v vi vii viii ix x norte sur este oeste centro 1 2 3 4 5 6 7 8 9".split())

_CANON = {k: k for k in NICKNAMES} | {n: k for k, v in NICKNAMES.items() for n in v.split()}
_ACT = {}
for _a in ACTIVITIES:
    _w = [[x, *WORDS[x].split()] for x in _a.split()]
    _ACT |= {"-".join(c): _a for c in product(*_w)}
    if len(_w) > 1:
        _ACT["".join(x[0][0] for x in _w)] = _a
_ACT_WORDS = frozenset(p for w in _ACT for p in w.split("-") if len(p) > 1)
_LEGAL_WORDS = frozenset(p for k in LEGAL for p in k.split())
#: Words that need no correction and that tokens are corrected to, whatever their count.
LEXICON = frozenset(_CANON) | frozenset(COMPOUND) | frozenset(p for w in _ACT for p in w.split("-") if len(p) > 3) | frozenset(p for p in _LEGAL_WORDS if len(p) > 3)
#: Gain of a correction to a word of the lexicon.
LEXICAL = 1_000_000
#: A token is rare up to this number of spellings, or up to this part of the number that a token met at random has: the bound grows with the vocabulary's counts.
RARE, RARE_PART = 3, 1 / 50
#: Rows, and characters of their first column, that Python holds before it passes them on: words and names multiply, and what a batch makes has no bound.
PIECE, PIECE_CHARS = 20_000, 1 << 20
_LEGAL_WORDS_MOST = max(len(k.split()) for k in LEGAL)


def fold(text: str) -> str:
    """Lower case without accents; blanks of any kind alike."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def tokens_of(text: str) -> list[str]:
    """Folded tokens in order; ',' stands for itself, initials keep their dot, dotted abbreviations lose theirs."""
    t = re.sub(r"\bm\.?ª", "maria ", text.lower()).replace("ª", "a").replace("º", "o")
    t = fold(t).replace("&", " & ").replace(",", " , ").replace("-", " ").replace("’", "'")
    out: list[str] = []
    for w in t.split():
        bare = w.replace(".", "")
        if w in (",", "&"):
            out.append(w)
        elif not bare:
            continue
        elif len(bare) == 1:
            if "." in w or bare not in "ye":
                out.append(bare + ".")
        elif re.fullmatch(r"[a-z]\.[a-z]{3,}\.?", w):  # M.Angel
            out += [bare[0] + ".", bare[1:]]
        elif len(bare) == 2 and re.fullmatch(r"[a-z]\.[a-z]\.?", w) and bare not in LEGAL and bare not in _ACT and bare not in TITLES:
            out += [c + "." for c in bare]  # A.B. -> A. B.
        else:
            out.append(bare)
    return out


def _distance(a: str, b: str, most: int) -> int:
    """Edits of insertion, deletion, substitution and transposition of neighbours, up to most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if two and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


def _deletions(t: str, most: int) -> set[str]:
    out, last = {t}, {t}
    for _ in range(most):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(len(x))}
        out |= last
    return out


def _around(t: str) -> Iterator[tuple[str, int]]:
    """What a token meets near ones at, and the deletions needed: itself and its sound, one deletion, two in words of six letters or more; pairs of places one by one."""
    most = 2 if len(t) >= 6 else 1 if len(t) > 3 else 0
    yield from ((v, 1) for v in _deletions(t, min(most, 1)) | {"~" + _sound(t)})
    if most == 2:
        yield from ((v, 2) for v in (_deletions(t, 2) - _deletions(t, 1) if len(t) <= 64 else _two_deletions(t)))


def _two_deletions(t: str) -> Iterator[str]:
    """What two deletions leave, one by one, few of them repeatedly: of a letter's run the first goes, and of two places the left one first."""
    for i in range(len(t)):
        if not i or t[i] != t[i - 1]:
            u = t[:i] + t[i + 1 :]
            yield from (u[:j] + u[j + 1 :] for j in range(i, len(u)) if not j or u[j] != u[j - 1])


def _pieces(rows: Iterable[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of PIECE rows at most, of fewer where the first column is long."""
    out, chars = [], 0
    for r in rows:
        out.append(r)
        chars += len(r[0])
        if len(out) == PIECE or chars > PIECE_CHARS:
            yield pd.DataFrame(out, columns=columns)
            out, chars = [], 0
    yield pd.DataFrame(out, columns=columns)


def _sound(t: str) -> str:
    """Letters that Spanish speakers take for one another."""
    for a, b in (("ll", "y"), ("ny", "n"), ("ch", "sh"), ("qu", "k"), ("z", "s"), ("v", "b"), ("ce", "se"), ("ci", "si"), ("ge", "je"), ("gi", "ji"), ("h", "")):
        t = t.replace(a, b)
    return t


def _initial(t: str) -> bool:
    return len(t) == 2 and t[1] == "."


def _legal_words(t: list[str]) -> int:
    """How many words at the end are a legal form, something being in front of it."""
    return next((n for n in range(min(_LEGAL_WORDS_MOST, len(t) - 1), 0, -1) if t[-1] in _LEGAL_WORDS and " ".join(t[-n:]) in LEGAL), 0)


def _organisation(tokens: list[str]) -> dict | None:
    """Brand, activity, qualifiers and legal form; None if the tokens name no organisation."""
    t = [x for x in tokens if x not in (",", "&") and x not in PARTICLES]
    tail = len(t)
    while tail and _initial(t[tail - 1]):
        tail -= 1
    glued = "".join(x[0] for x in t[tail:])  # S. A.
    legal = None
    if tail and glued in LEGAL:
        legal, t = LEGAL[glued], t[:tail]
    if legal is None and (n := _legal_words(t)):
        legal, t = LEGAL[" ".join(t[-n:])], t[:-n]
    act, k = None, 0
    rest: list[str] = []
    while k < len(t):
        two = f"{t[k]}-{t[k + 1]}" if k + 1 < len(t) else ""
        if act is None and two in _ACT:
            act, k = _ACT[two], k + 2
        elif act is None and t[k] in _ACT and (len(t[k]) > 2 or k in (0, len(t) - 1)):
            act, k = _ACT[t[k]], k + 1
        else:
            rest.append(t[k])
            k += 1
    if act is None and legal is None:
        return None
    qual = [x for x in rest if x.rstrip(".") in QUALIFIERS]
    brand = [x for x in rest if x.rstrip(".") not in QUALIFIERS]
    if not brand:
        return None
    return {"kind": "O", "brand": brand, "act": act or "-", "qual": " ".join(sorted(q.rstrip(".") for q in qual)), "legal": legal}


def _person(tokens: list[str], more: frozenset[str] = frozenset()) -> dict | None:
    """Given names (canonical, or initials) and surnames, whatever their order. more: given names besides the listed ones."""
    t = list(tokens)
    while len(t) > 2 and t[0] in TITLES:
        t = t[1:]
    known = lambda x: x in _CANON or x in COMPOUND or x in more
    if len(t) > 2 and t[0] == "d." and any(known(x) or _initial(x) for x in t[1:]):
        t = t[1:]  # Don
    if "," in t:
        cut = t.index(",")
        last, first = t[:cut], [x for x in t[cut + 1 :] if x != ","]
        first = [x for x in first if x not in TITLES] or first
    else:
        t = [x for x in t if x != "&"]
        core = [x for x in t if x not in PARTICLES]
        n = 0
        while n < len(core) - 1 and known(core[n]):
            n += 1
        if n and n < len(core):
            if _initial(core[n]) and n + 1 < len(core) and not _initial(core[n + 1]):
                n += 1
            first, last = core[:n], core[n:]
        else:
            n = 0
            while n < len(core) - 1 and known(core[-1 - n]):
                n += 1
            if n and n < len(core):
                if len(core) - n > 2 and _initial(core[-1 - n]):  # ... M. Teresa
                    n += 1
                first, last = core[-n:], core[:-n]
            else:
                n = 0
                while n < len(core) and _initial(core[n]):
                    n += 1
                while n and n < len(core) - 1 and known(core[n]):  # J. Luis
                    n += 1
                if n and n < len(core):
                    first, last = core[:n], core[n:]
                else:
                    n = 0
                    while n < len(core) and _initial(core[-1 - n]):
                        n += 1
                    if not n or n >= len(core):
                        return None
                    first, last = core[-n:], core[:-n]
    first = [x for x in first if x not in PARTICLES]
    last = [x for x in last if x not in PARTICLES and x not in (",", "&")]
    if not first or not last or _initial(last[0]):
        return None
    given: list[str] = []
    for x in first:
        given += COMPOUND[x].split() if x in COMPOUND else [_CANON.get(x, x)]
    full = not any(_initial(x) for x in given)
    second = last[1:] if len(last) < 3 else ["".join(last[1:])]
    return {"kind": "P", "given": " ".join(given) if full else None, "gi": "".join(x[0] for x in given), "s1": last[0], "s2": second[0] if second and not _initial(second[0]) else None, "s2i": second[0][0] if second else None, "lexical": all(x in NICKNAMES for x in given)}


def _other(tokens: list[str]) -> dict | None:
    """What no rule reads: its words without titles, particles and legal form, whatever their order; None if there is no word."""
    t = [x for x in tokens if x not in (",", "&")]
    while len(t) > 1 and t[0] in TITLES:
        t = t[1:]
    t = [x for x in t if x not in PARTICLES]
    if n := _legal_words(t):
        t = t[:-n]
    return {"kind": "X", "words": sorted(t)} if any(c.isalnum() for x in t if not _initial(x) for c in x) else None


def legal_form(tokens: list[str]) -> str | None:
    """The legal form at the end of an organisation's name, None if it has none or is read as a person."""
    r = _organisation(tokens)
    return r["legal"] if r else None


def hypotheses(tokens: list[str]) -> set[str]:
    """Shorter forms under every reading of an unread name's words as given names and surnames, in either order; what initials may stand for."""
    t = [x for x in tokens if x not in (",", "&") and x not in PARTICLES and x not in TITLES]
    if not 2 <= len(t) <= 5 or any(_initial(x) for x in t):
        return set()
    out = set()
    for k in range(1, len(t)):
        for first, last in ((t[:k], t[k:]), (t[k:], t[:k])):
            if len(first) < 3 and len(last) < 4:
                second = "".join(last[1:]) if len(last) > 1 else "-"
                own = f"P|{' '.join(_CANON.get(x, x) for x in first)}|{last[0]}|{second}"
                out |= {own, *forms_of(own)}
    return out


def parse(tokens: list[str], more: frozenset[str] = frozenset()) -> dict | None:
    return _organisation(tokens) or _person(tokens) or (_person(tokens, more) if more else None)


def positions(tokens: list[str]) -> list[tuple[str, int]]:
    """Unlisted words of a person's name: (word, 1) behind the comma, where given names stand, (word, 0) elsewhere."""
    r = parse(tokens)
    if r is None or r["kind"] != "P":
        return []
    cut = tokens.index(",") if "," in tokens else len(tokens)
    return [(x, int(k > cut)) for k, x in enumerate(tokens) if len(x) > 2 and x not in _CANON and x not in COMPOUND and x not in TITLES and x not in PARTICLES]


def key_of(r: dict) -> tuple[str, int]:
    """The record's own form, and how specific it is (6: everything is spelled out; 0: unread)."""
    if r["kind"] == "X":
        return f"X|{' '.join(r['words'])}", 0
    if r["kind"] == "O":
        return f"O|{' '.join(r['brand'])}|{r['act']}|{r['qual']}", 6
    g = r["given"] or f"{r['gi']}."
    s = r["s2"] or (f"{r['s2i']}." if r["s2i"] else "-")
    return f"P|{g}|{r['s1']}|{s}", 6 - (0 if r["given"] else 2) - (0 if r["s2"] else 1 if r["s2i"] else 3)


def forms_of(key: str) -> list[str]:
    """All canonical rewritings that say less: given names as initials, second surname as initial or left out."""
    if key[0] != "P":
        return []
    _, g, s1, s2 = key.split("|")
    gs = [g] if g.endswith(".") else [g, "".join(x[0] for x in g.split()) + "."]
    ss = [s2, "-"] if s2.endswith(".") else ["-"] if s2 == "-" else [s2, s2[0] + ".", "-"]
    return [f"P|{a}|{s1}|{b}" for a in gs for b in ss if (a, b) != (g, s2)]


def rewritings(tokens: list[str], fixes: dict[str, list[tuple[str, int, int]]], max_edits: int, more: frozenset[str] = frozenset(), own: dict | None = None) -> Iterator[dict[str, tuple[int, int]]]:
    """Forms of the name at its own specificity: (edits, -how much commoner the corrected tokens are), the least of each; as typed (0, 0).

    A name that can't be read as typed has unread forms, too. Forms come in pieces of PIECE; one that is in several has its least value in one of them.
    """
    own = own or parse(tokens, more)
    unread = own is None
    if not unread and fixes.keys().isdisjoint(tokens):
        yield {key_of(own)[0]: (0, 0)}
        return
    choices = [[(t, 0, 0), *fixes.get(t, ())] for t in tokens]

    def go(i: int, chosen: list[str], cost: int, gain: int):
        if i == len(choices):
            yield chosen, (cost, -gain)
            return
        for t, c, g in choices[i]:
            if cost + c <= max_edits:
                yield from go(i + 1, [*chosen, t], cost + c, gain + g)

    out: dict[str, tuple[int, int]] = {}
    for chosen, v in go(0, [], 0, 0):
        for r in (parse(chosen, more), _other(chosen) if unread else None):
            k = key_of(r)[0] if r else None
            if k and (k not in out or v < out[k]):
                out[k] = v
        if len(out) >= PIECE:
            yield out
            out = {}
    yield out


def _told(lines: str) -> tuple[dict[str, list[tuple[str, int, int]]], frozenset[str]]:
    """Corrections of a name's tokens, (token, edits, gain) each, and given names besides the listed ones."""
    fixes, more = {}, set()
    for x in lines.split("\n") if lines else ():
        words, given = x.split("\t")
        t, *w = words.split(" ")
        if w:
            fixes[t] = [(w[k], int(w[k + 1]), int(w[k + 2])) for k in range(0, len(w), 3)]
        more.update(given.split())
    return fixes, frozenset(more)


def link_variants(names: DataFrame, *, name: str = "name", max_edits: int = 4, rare: int = RARE, ratio: int = 3) -> DataFrame:
    """(name, entity) for every spelling with a word in it; spellings of one entity denote one person or organisation.

    1. Tokens that are rare beside a token within two edits (one below six letters), or that sound alike, may stand for it. What is rare follows the
       vocabulary: rare spellings, or RARE_PART of those that a token met at random has.
    2. Every reading of a spelling is rewritten to a canonical form: titles, particles and legal forms go, nicknames and
       abbreviations are spelled out, the token order is undone; each correction counts its edits.
    3. Forms are exploded and joined by equality. A spelled-out form that is rare beside another one reachable by edits is a misspelling of it.
       Less specific spellings (initials, one surname) join the forms that more specific ones can be shortened to. The score of
       a link is the rarity of the shared form, 1 / number of entities it may denote at the least number of edits; only a score of 1 links.
    4. Spellings without listed given name, initial, comma, activity or legal form have their words in any order as form; it is joined with the words
       of the spellings that were read, and misspellings among the rest are corrected as in 3. Words that stand behind commas more often than elsewhere
       are given names like the listed ones. Short spellings that met nothing join what such words may be shortened to under any reading of them as names.
    5. Two different legal forms are two entities: a misspelling with another legal form than the entity's own is set apart, and where spellings of its very form have
       several, each keeps those of its own, and spellings without one stay apart, as they may denote either. A legal form that is left out doesn't count otherwise.
    names: spellings, repeated ones and other columns making no difference. Null, empty and wordless spellings get no row; ties go to
    the alphabetically first form; an empty table gives an empty result.
    """
    spark = names.sparkSession
    reach_package(spark)
    base = names.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()

    def cut(batches):
        for pdf in batches:
            toks = [tokens_of(x) for x in pdf["name"]]
            keep = [bool(t) for t in toks]
            yield pd.DataFrame({"name": pdf["name"], "tokens": toks, "legal": [legal_form(t) for t in toks]})[keep]

    typed = materialize(base.mapInPandas(cut, "name string, tokens array<string>, legal string"), "names-typed")

    # 1. corrections of tokens
    lexicon = spark.createDataFrame([(w,) for w in sorted(LEXICON)], "t string")
    support = typed.select(F.explode(F.array_distinct("tokens")).alias("t")).where(F.length("t") >= 3).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    vocab = support.join(F.broadcast(lexicon.withColumn("lex", F.lit(True))), "t", "full_outer").select("t", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("lex", F.lit(False)).alias("lex"))
    vocab = materialize(vocab, "names-vocabulary")
    met_at_random = vocab.agg(F.sum(F.col("n") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).first()[0] or 0
    rare = max(rare, int(met_at_random * RARE_PART))

    def near(batches):
        for pdf in batches:
            yield from _pieces(((t, n, lex, v, far) for t, n, lex in zip(pdf["t"], pdf["n"], pdf["lex"]) for v, far in _around(t)), ["t", "n", "lex", "v", "far"])

    around = materialize(vocab.mapInPandas(near, "t string, n bigint, lex boolean, v string, far int"), "names-around")
    wrong = around.where("not lex").select("v", "far", "t", F.col("n").alias("nt"))
    right = around.select("v", F.col("far").alias("_far"), F.col("t").alias("u"), F.col("n").alias("nu"), F.col("lex").alias("ulex"))
    gain = F.when(F.col("ulex"), LEXICAL).otherwise(F.col("nu") - F.col("nt")).alias("gain")

    def measure(batches):
        for pdf in batches:
            d = []
            for t, u in zip(pdf["t"], pdf["u"]):
                most = 2 if min(len(t), len(u)) >= 6 else 1
                k = _distance(t, u, most)
                d.append(k if k <= most else 1 if _sound(t) == _sound(u) else 9)
            yield pdf.assign(d=d)

    def measured(pairs: DataFrame) -> DataFrame:
        return pairs.select("t", "u", gain).distinct().mapInPandas(measure, "t string, u string, gain bigint, d int").where("d < 9")

    # common tokens, or listed ones, in place of rarer ones; the planner can't know how many rows the deletions make: never broadcast them
    often = right.where(F.col("ulex") | (F.col("nu") > rare))
    common = materialize(measured(wrong.join(often.hint("merge"), "v").where((F.col("t") != F.col("u")) & (F.col("ulex") | (F.col("nu") >= ratio * F.col("nt"))))), "names-common")
    # a token is taken for another rare one only if that is nearer than any common one: misspellings of one word are many, and near each other. Pairs
    # of rare tokens meet at one deletion, or at two if they begin alike, which keeps the groups that meet short
    least = common.groupBy("t").agg(F.min("d").alias("_any"))
    lone_ones = wrong.where(F.col("nt") <= rare).join(least, "t", "left").where(F.col("_any").isNull() | (F.col("_any") > 1)).where(F.col("_any").isNull() | (F.col("far") == 1))
    block = lambda far, t: F.explode(F.when(F.col(far) == 1, F.array(F.lit(""), F.substring(t, 1, 1))).otherwise(F.array(F.substring(t, 1, 1))))
    peers = right.where((F.col("nu") < ratio * rare) & ~F.col("ulex")).withColumn("_k", block("_far", "u"))
    pairs = lone_ones.withColumn("_k", block("far", "t")).join(peers.hint("merge"), ["v", "_k"]).where((F.col("t") != F.col("u")) & (F.col("nu") >= F.col("nt")) & ~((F.col("nu") > rare) & (F.col("nu") >= ratio * F.col("nt"))))
    rares = measured(pairs).join(least, "t", "left").where(F.col("_any").isNull() | (F.col("d") < F.col("_any"))).drop("_any")
    near_ones = common.unionByName(rares)
    fixes = near_ones.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("d", "u", "gain"))).alias("fixes"))

    def place(batches):
        for pdf in batches:
            yield from _pieces((p for toks in pdf["tokens"] for p in positions(list(toks))), ["t", "behind"])

    # given names besides the listed ones, unless they may be misspellings of these
    placed = typed.select("tokens").mapInPandas(place, "t string, behind int").groupBy("t").agg(F.sum("behind").alias("_g"), F.count(F.lit(1)).alias("_n")).where("2 * _g > _n")
    given = materialize(placed.join(common.where(F.col("gain") == LEXICAL).select("t").distinct(), "t", "left_anti").select("t", F.lit(True).alias("given")), "names-given")
    fixes = fixes.join(given, "t", "full_outer")
    fixes = fixes.select("t", "fixes", "given", F.explode_outer("fixes").alias("_x")).join(given.select(F.col("t").alias("_u"), F.col("t").alias("_gu")), F.col("_x.u") == F.col("_u"), "left").groupBy("t").agg(F.first("fixes").alias("fixes"), F.array_compact(F.array_append(F.collect_set("_gu"), F.first(F.when(F.col("given"), F.col("t"))))).alias("given"))

    # a line for each token: it and its corrections, a tab, given names; no token holds a blank. A batch of nested rows is many times larger in Python than one of lines
    line = F.concat_ws("\t", F.concat_ws(" ", "t", F.transform("fixes", lambda x: F.concat_ws(" ", x["u"], x["d"].cast("string"), x["gain"].cast("string")))), F.concat_ws(" ", "given"))
    fixes = fixes.select("t", line.alias("fix"))

    # 2. rewritings
    # words meet their corrections one by one and come together again as the name's tokens, so that names are shuffled once
    apart = typed.select("name", F.posexplode("tokens").alias("k", "t")).join(fixes.hint("merge"), "t", "left")
    full = apart.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("k", "t"))).alias("_t"), F.concat_ws("\n", F.collect_list("fix")).alias("fx"))
    full = full.select("name", F.transform("_t", lambda x: x["t"]).alias("tokens"), "fx")

    def rewritten(pdf):
        for nm, toks, fx in zip(pdf["name"], pdf["tokens"], pdf["fx"]):
            toks = list(toks)
            fix, more = _told(fx)
            read = parse(toks, more)
            own = read or _other(toks)
            mine = key_of(own) if own else ("", 0)
            for piece in rewritings(toks, fix, max_edits, more, read):
                for k, (c, g) in piece.items():
                    yield nm, mine[0], mine[1], k, _specific(k), c, -g

    def rewrite(batches):
        for pdf in batches:
            yield from _pieces(rewritten(pdf), ["name", "own", "own_level", "form", "level", "cost", "gain"])

    forms = materialize(full.mapInPandas(rewrite, "name string, own string, own_level int, form string, level int, cost int, gain bigint"), "names-forms")

    def shorten(batches):
        for pdf in batches:
            yield from _pieces(((e, f, int(not _lexical(e))) for e in pdf["entity"] for f in forms_of(e)), ["entity", "form", "odd"])

    # 3a. spelled-out forms and their misspellings
    complete = forms.where("cost = 0 and level = 6").select("form").distinct()
    # what every spelled-out form may be corrected to, once for all spellings that have it
    ways = forms.where("level = 6 and cost > 0 and own_level = 6 and own <> form").groupBy(F.col("own").alias("wrong"), "form").agg(F.min(F.struct("cost", -F.col("gain"))).alias("_v")).select("wrong", "form", "_v.cost", (-F.col("_v.col2")).alias("gain"))
    ways = materialize(ways.join(complete.withColumn("typed", F.lit(True)), "form", "left"), "names-ways")
    alt = ways.where("typed")
    # corrected tokens are commoner (of equals, the form is the first by alphabet), so no form is corrected to itself in the end
    better = alt.where((F.col("gain") > 0) | ((F.col("gain") == 0) & (F.col("form") < F.col("wrong"))))
    step = better.groupBy("wrong").agg(F.min_by("form", F.struct("cost", -F.col("gain"), "form")).alias("form"))
    # misspellings of one form that nobody typed rightly: two different ones that the same commoner tokens correct to the same form
    lone = materialize(ways.where(F.col("typed").isNull() & (F.col("gain") >= 2 * rare)).join(step.select("wrong"), "wrong", "left_anti"), "names-lone")
    met = lone.groupBy("form").agg(F.countDistinct("wrong").alias("_k")).where("_k > 1").select("form")
    untyped = lone.join(met, "form").groupBy("wrong").agg(F.min_by("form", F.struct("cost", -F.col("gain"), "form")).alias("form"))
    step = _followed(materialize(step.unionByName(untyped), "names-misspelled"))  # a misspelling of a misspelling
    roots = complete.select("form").join(step.select(F.col("wrong").alias("form"), F.col("form").alias("entity")), "form", "left").select("form", F.coalesce("entity", "form").alias("entity"))
    roots = materialize(roots.unionByName(roots.select(F.col("entity").alias("form"), "entity")).distinct(), "names-complete")
    first = forms.where("level = 6").join(roots, "form").select("name", "entity", "cost")
    whole = _unique(first.withColumn("odd", F.lit(0)).join(forms.where("own_level = 6").select("name").distinct(), "name", "left_semi"))

    # 3b. less specific spellings: forms that entities can be shortened to
    short = roots.select("entity").distinct().mapInPandas(shorten, "entity string, form string, odd int").select("entity", "form", "odd", F.lit(0).alias("far"))
    # right but short spellings of an entity whose full spellings are all wrong: what these may be corrected to is shortened as well
    fixed = lone.join(roots.select(F.col("form").alias("wrong"), F.col("entity").alias("_e")), "wrong").groupBy(F.col("form").alias("entity"), "_e").agg(F.min("cost").alias("far"))
    reach = fixed.select("entity").distinct().mapInPandas(shorten, "entity string, form string, odd int")
    short = short.unionByName(reach.hint("merge").join(fixed, "entity").select(F.col("_e").alias("entity"), "form", "odd", "far")).groupBy("entity", "form").agg(F.min("odd").alias("odd"), F.min("far").alias("far"))
    short = _two(short, "odd", "far").hint("merge")
    less = forms.where("own_level < 6")
    hits = less.where("level < 6").join(short, "form").select("name", "entity", (F.col("cost") + F.col("far")).alias("cost"), "odd").unionByName(first.withColumn("odd", F.lit(0)).join(less.select("name").distinct(), "name", "left_semi"))
    partial = _unique(hits)
    linked = materialize(whole.unionByName(partial), "names-linked")

    # 3c. what is left: among each other, more specific forms first
    every = materialize(forms.where("own <> ''").join(linked.select("name"), "name", "left_anti"), "names-left")
    left = every.where("own_level > 0")
    own = left.where("cost = 0 and form = own").select("form", "level").distinct()
    short2 = _two(own.select(F.col("form").alias("entity")).mapInPandas(shorten, "entity string, form string, odd int"), "odd").hint("merge")
    up = _unique(left.where("cost = 0 and form = own").select(F.col("form").alias("name")).distinct().join(short2, F.col("name") == short2["form"]).select("name", "entity", F.lit(0).alias("cost"), "odd")).select(F.col("name").alias("own"), "entity")
    rest = left.select("name", "own").distinct().join(up, "own", "left").select("name", F.coalesce("entity", "own").alias("entity"))
    read = materialize(linked.unionByName(rest), "names-read")

    # 4. what no rule reads: the words of a spelling that was read, else of another unread one, corrected or as typed
    def words(batches):
        for pdf in batches:
            found = [_other(list(t)) for t in pdf["tokens"]]
            yield pd.DataFrame({"entity": pdf["entity"], "form": [key_of(r)[0] if r else None for r in found]})

    unread = every.where("own_level = 0 and level = 0")
    same = typed.join(read.hint("merge"), "name").select("entity", "tokens").mapInPandas(words, "entity string, form string").where("form is not null").distinct().hint("merge")
    met = materialize(_unique(unread.join(same, "form").select("name", "entity", "cost", F.lit(0).alias("odd"))), "names-met")
    alone = materialize(unread.join(met.select("name"), "name", "left_anti"), "names-unread")
    typed_so = alone.where("form = own").select("form").distinct()
    wrong_ones = alone.where("form <> own").join(typed_so, "form", "left_semi").where((F.col("gain") > 0) | ((F.col("gain") == 0) & (F.col("form") < F.col("own"))))
    up_to = materialize(wrong_ones.groupBy(F.col("own").alias("wrong")).agg(F.min_by("form", F.struct("cost", -F.col("gain"), "form")).alias("form")), "names-unread-misspelled")
    up_to = _followed(up_to)
    others = alone.select("name", "own").distinct().join(up_to.select(F.col("wrong").alias("own"), F.col("form").alias("_up")), "own", "left").select("name", F.coalesce("_up", "own").alias("entity"))

    # short spellings that met nothing, among what unread ones may be shortened to
    def guess(batches):
        for pdf in batches:
            yield from _pieces(((e, f) for e, t in zip(pdf["entity"], pdf["tokens"]) for f in hypotheses(list(t))), ["entity", "form"])

    single = left.where("cost = 0 and form = own").select("name", "form").distinct()
    guessed = others.join(typed.select("name", "tokens"), "name").select("entity", "tokens").mapInPandas(guess, "entity string, form string")
    guessed = _two(guessed).hint("merge")
    found = materialize(_unique(single.join(guessed, "form").select("name", "entity", F.lit(0).alias("cost"), F.lit(0).alias("odd"))), "names-guessed")
    # the whole group that a short spelling stands for moves with it
    moved = found.join(read, "name").select(read["entity"].alias("_from"), found["entity"].alias("_to")).groupBy("_from").agg(F.min("_to").alias("_to"), F.count_distinct("_to").alias("_k")).where("_k = 1")
    read = read.join(moved.select(F.col("_from").alias("entity"), "_to"), "entity", "left").select("name", F.coalesce("_to", "entity").alias("entity"))
    return _by_legal_form(read.unionByName(met).unionByName(others), typed, forms.select("name", "own").distinct())


def _by_legal_form(linked: DataFrame, typed: DataFrame, own: DataFrame) -> DataFrame:
    """Entities whose spellings have different legal forms, each spelling that tells one apart under it.

    Spellings of the entity's very form say which legal forms it has; if that is one, only a misspelling with another one is set apart.
    """
    of = linked.join(typed.select("name", "legal"), "name").join(own, "name", "left")
    legal, exact = F.col("legal"), F.col("own") == F.col("entity")
    told = of.where("legal is not null").groupBy("entity").agg(F.collect_set("legal").alias("_all"), F.collect_set(F.when(exact, legal)).alias("_exact")).where(F.size("_all") > 1)  # sets of listed legal forms
    several = F.when(F.size("_exact") == 0, F.lit(True)).otherwise((F.size("_exact") > 1) | ~F.array_contains("_exact", legal))
    apart = F.col("_all").isNotNull() & legal.isNotNull() & several
    return of.join(told, "entity", "left").select("name", F.when(apart, F.concat_ws("|", "entity", "legal")).otherwise(F.col("entity")).alias("entity"))


def _followed(step: DataFrame) -> DataFrame:
    """(wrong, form) with the last form of each chain of corrections; corrections never go round."""
    while True:
        nxt = step.select(F.col("wrong").alias("form"), F.col("form").alias("_up"))
        step = materialize(step.join(nxt, "form", "left").select("wrong", F.coalesce("_up", "form").alias("form")), "names-followed")
        if step.join(step.select(F.col("wrong").alias("form")), "form", "left_semi").isEmpty():
            return step


def _specific(key: str) -> int:
    if key[0] != "P":
        return 6 if key[0] == "O" else 0
    _, g, _, s2 = key.split("|")
    return 6 - (2 if g.endswith(".") else 0) - (3 if s2 == "-" else 1 if s2.endswith(".") else 0)


def _lexical(key: str) -> bool:
    """Whether all given names of a form are known ones: others are misspelled beyond two edits."""
    return key[0] != "P" or all(g in NICKNAMES for g in key.split("|")[1].split())


def _unique(hits: DataFrame) -> DataFrame:
    """The entity of each name at its least cost (known given names before others), where the form is so rare that it is only one."""
    best = hits.groupBy("name", "entity").agg(F.min(F.struct("cost", "odd")).alias("cost"))
    w = Window.partitionBy("name")
    best = best.withColumn("_least", F.min("cost").over(w)).where("cost = _least")
    return best.groupBy("name").agg(F.min("entity").alias("entity"), F.count(F.lit(1)).alias("_k")).where("_k = 1").select("name", "entity")


def _two(short: DataFrame, *at: str) -> DataFrame:
    """(entity, form, *at) with two entities, if there are, for each form at the same distance: two already tell _unique that it denotes none, and
    common forms (an initial and a surname) have entities as many as the names that would meet them all."""
    ends = short.repartition("form").groupBy("form", *at).agg(F.min("entity").alias("_a"), F.max("entity").alias("_b"))
    return ends.select(F.explode(F.array_distinct(F.array("_a", "_b"))).alias("entity"), "form", *at)


def variant_pairs(linked: DataFrame) -> DataFrame:
    """(name_a, name_b) of all spellings of one entity, in binary order: the result asked for lists them all."""
    a = linked.select(F.col("name").alias("name_a"), "entity")
    b = linked.select(F.col("name").alias("name_b"), "entity")
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")

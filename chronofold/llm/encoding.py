"""Garbled text from wrong character encodings: candidate decodings judged by description length.

A stretch of text is compressed, as it stands and as each chain of re-decodings would make it, with zstandard dictionaries trained per
language on a bounded sample of the documents. The chain of least description length, its own cost included, wins; if that is the
empty chain, the stretch stays unchanged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import reach_package

RESULT = "doc_id bigint, status string, chains string, n_stretches int, restored string"

#: Letters and typographic signs of the languages written with them (es ca pt fr de en el; Polish letters are always looked at).
LETTERS = "áéíóúñüçàèìòùâêîôûëïöäßãõÿœæ"
SIGNS = "«»¿¡–—‘’“”„…€·ºª°§©®±½¼¾×☐☒•­​ ﬁﬂ"
_ALPHABET = LETTERS + LETTERS.upper().replace("SS", "") + SIGNS
_LOW, _UP = "a-zà-öø-ÿ", "À-ÖØ-ÞŸŒŠŽ"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_TRAIL = "\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
#: Characters out of place in any language. Every match
#: begins with a character beyond ASCII, so that both regex engines pass over the rest at the cost of one test.
SUSPICIOUS = "(?=[^\\x00-\\x7f])(?:" + "|".join([
    f"[^{_ALPHABET}\u0300-\u036fͰ-Ͽ]",  # a character of no expected alphabet
    f"[ÂÃÄÅÆÌÎÏÐâãäåæìîïð][{_TRAIL}]",  # lead and trail of a UTF-8 sequence
    f"(?<=[{_LOW}])[{_UP}]",  # capital inside a word
    f"(?<=[{_LETTER}])[«¡¿§©®±½¼¾×°ªº“”„‘•–—…€](?=[{_LETTER}])",  # sign inside a word
    f"(?<=[{_LETTER}])[¡¿«±½¼¾§©®×•]",  # sign stuck to a word
    f"(?<![lL ])·(?=[{_LETTER}])|(?<=[{_LETTER}])·(?![lL])",
    "(?![çÇ][ãõÃÕ])[À-ÖØ-öø-ÿ]{2}",  # accented letters in a row
    f"(?<=[{_LETTER}])[Ͱ-Ͽ]|[Ͱ-Ͽ](?=[{_LETTER}])",  # Greek and Latin in one word
]) + ")"
#: Letters that texts of a language are expected to hold; Spanish ones are in names everywhere.
USED = {l: "áéíóúñüçªº" + x for l, x in {"es": "", "ca": "àèïò", "pt": "âãàêôõ", "fr": "àâæèêëîïôœùûÿ", "de": "äöß", "en": ""}.items()}
#: A capital with an accent that begins a word, or is one, behind a word in lower case.
_CAPITALS = "(?<=[a-zà-ö,] )[ÀÁÈÉÌÍÒÓÙÚÂÊÎÔÛÄËÏÖÜ](?=[a-z]| [a-z])"


def gate(languages: tuple[str, ...]) -> str:
    """SUSPICIOUS, and what may be a wrong reading in texts of these languages only: letters that none of them uses, capitals at odd places."""
    letters = [USED[l] for l in languages if l in USED]
    foreign = "" if not letters else "".join(c for c in LETTERS if not any(c in u for u in letters))
    return SUSPICIOUS[:-1] + f"|[{foreign}{foreign.upper().replace('SS', '')}]" * bool(foreign) + f"|{_CAPITALS})"


#: What no clean document is expected to hold; documents without it may train the dictionaries. Polish letters belong to Polish.
UNCLEAN = SUSPICIOUS.replace(_ALPHABET, _ALPHABET + "ąćęłńśźżĄĆĘŁŃŚŹŻ", 1)

#: Bits that a chain costs the first time a document needs it: valid UTF-8 is hardly met by accident, single-byte readings are.
UTF8_BITS, REPEAT_BITS, SINGLE_BITS, AGAIN_BITS = 4, 2, 13, 1
#: Steps up to which every reading is read further; beyond them the shortest of each step is, as their number would multiply.
ALL_STEPS = 3
#: Bits that a repeated reading of UTF-8 costs besides if its encoding is another one than the step's before.
SWITCH_BITS = 6
#: Bits that it costs besides if text was meant in an old system's encoding, or in one of another script than its language's, and what languages are written in.
OLD_BITS, FOREIGN_BITS = 20, 40
MEANT = {"pl": ("cp1250", "iso8859_2"), "el": ("cp1253", "iso8859_7")}
OLD = frozenset(("mac_roman", "cp437", "cp850", "latin1"))
#: Bits that a single-byte reading costs besides if no fewer characters are out of place by it: lengths of short stretches differ by some bytes for no reason.
IDLE_BITS = 32
#: Bits for every character out of place that a reading leaves, as the dictionaries' letter codes hardly tell rare bytes apart.
ODD_BITS = 6
#: Characters up to which a stretch is measured together with the one in front of it.
SHORT = 60


@lru_cache(None)
def _high(codec: str) -> dict[str, int]:
    """Character to byte for bytes of 0x80 and more; bytes that cp125x leave undefined stand for the control of that number."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        if ord(c) > 127:
            out.setdefault(c, b)
    return out


@lru_cache(None)
def _utf8(codec: str) -> tuple[re.Pattern, dict[str, int], frozenset[str]]:
    high = _high(codec)
    cls = lambda a, b: "[" + "".join(re.escape(c) for c, n in high.items() if a <= n <= b) + "]"
    t = cls(0x80, 0xBF)
    return re.compile(f"{cls(0xC2, 0xDF)}{t}|{cls(0xE0, 0xEF)}{t}{t}|{cls(0xF0, 0xF4)}{t}{t}{t}"), high, frozenset(c for c, n in high.items() if 0xC2 <= n <= 0xF4)


def _as_utf8(codec: str, text: str) -> str:
    pattern, high, _ = _utf8(codec)

    def sub(m: re.Match) -> str:
        try:
            return bytes(high[c] for c in m.group()).decode()
        except UnicodeDecodeError:
            return m.group()

    return pattern.sub(sub, text)


@lru_cache(None)
def _table(wrong: str, right: str) -> dict[int, str]:
    out = {}
    for c, b in _high(wrong).items():
        try:
            r = bytes([b]).decode(right)
        except UnicodeDecodeError:
            continue
        if r != c and (ord(r) >= 0xA0 or ord(r) < 0x80):
            out[ord(c)] = r
    return out


_SUSPECT, _UNCLEAN = re.compile(SUSPICIOUS), re.compile(UNCLEAN)
_WIDE = re.compile("[^\\x00-\\x7f]{3,}")


def _narrow(order: str, codec: str, text: str) -> str:
    """Pairs of bytes that were read as UTF-16."""

    def sub(m: re.Match) -> str:
        try:
            out = m.group().encode(f"utf-16-{order}").decode(codec)
        except (UnicodeDecodeError, UnicodeEncodeError):
            return m.group()
        return out if sum(32 <= ord(c) < 127 or c in "\n\t" for c in out) > 0.7 * len(out) else m.group()

    return _WIDE.sub(sub, text)


_FOLDED = re.compile(f"[âãäåæçèéêëìíîïðñòóôõö]([{_TRAIL}]|[à-þ])")


def _unfolded(text: str) -> str:
    """Text that was put into lower case after it was garbled: the lead of a sequence in upper case again."""
    return _FOLDED.sub(lambda m: m.group()[0].upper() + m.group()[1], text)


#: Encodings that bytes are read by or were meant in; every ordered pair is a single-byte reading.
CODECS = ("cp1252", "latin1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "cp1253", "iso8859_7", "iso8859_2")
_HIGH, _EACH_HIGH = re.compile("[^\\x00-\\x7f]"), re.compile("([^\\x00-\\x7f])")


@lru_cache(1 << 14)
def _singles(chars: frozenset[str]) -> tuple[tuple[str, dict[str, str]], ...]:
    """Every different single-byte reading of these characters under the name of the first pair that makes it."""
    out: dict[tuple, tuple[str, dict[str, str]]] = {}
    order = sorted(chars)
    for wrong, right in ((w, r) for r in ("cp1252", *CODECS[2:], "latin1") for w in CODECS if w != r):
        table = _table(wrong, right)
        made = {c: table[ord(c)] for c in order if ord(c) in table}
        if made:
            out.setdefault(tuple(made.items()), (f"{right}<{wrong}", made))
    return tuple(out.values())


def _exchanged(text: str, *tables: dict[str, str]) -> Iterator[str]:
    """text with its characters beyond ASCII exchanged by each of the tables."""
    parts = _EACH_HIGH.split(text)
    high = parts[1::2]
    for made in tables:
        parts[1::2] = [made.get(c, c) for c in high]
        yield "".join(parts)


@lru_cache(None)
def _gate(languages: tuple[str, ...]) -> re.Pattern:
    return re.compile(gate(languages))


def _steps(text: str, first: bool):
    """All readings one step from text: (step, reading). Single-byte ones, and pairs of bytes that were read as UTF-16, at the first step."""
    chars = frozenset(_HIGH.findall(text))
    for codec in CODECS:
        if not chars.isdisjoint(_utf8(codec)[2]):
            yield f"utf-8<{codec}", _as_utf8(codec, text)
    up = _unfolded(text)
    if up != text:
        for codec in ("cp1252", "latin1"):
            r = _as_utf8(codec, up)
            if r != up:  # capitals alone decode nothing
                yield f"utf-8<lower({codec})", r
    if first:
        names, tables = zip(*singles) if (singles := _singles(chars)) else ((), ())
        yield from zip(names, _exchanged(text, *tables))
        for order in ("le", "be") if _WIDE.search(text) else ():
            for codec in ("cp1252", "utf-8"):
                yield f"{codec}<utf-16-{order}", _narrow(order, codec, text)


class Judge:
    """Description lengths by the dictionaries of all languages."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 7, odd_bits: int = ODD_BITS, every: bool = True):
        """odd_bits: what characters out of place cost. every: all readings are measured; False passes over single-byte ones that explain nothing odd, for comparison."""
        import zstandard

        self.odd_bits, self.every = odd_bits, every

        self.z, self.quick = {}, {}
        for lang, d in sorted(dictionaries.items()):
            for of, lev in ((self.z, level), (self.quick, 3)):
                data = zstandard.ZstdCompressionDict(d)
                data.precompute_compress(level=lev)
                of[lang] = zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    def language(self, text: str) -> str | None:
        raw = text.encode("utf-8", "surrogatepass")
        return min(self.quick, key=lambda k: (len(self.quick[k].compress(raw)), k), default=None)

    def bits(self, text: str, languages: set[str], capitals: bool = False) -> int:
        """Bits under the best of the languages; capitals: measured in lower case, which the dictionaries know better."""
        raw = (text.lower() if capitals else text).encode("utf-8", "surrogatepass")
        return 8 * min((len(self.z[k].compress(raw)) for k in languages if k in self.z), default=len(raw))

    def best(self, text: str, languages: set[str], used: set[str], before: str = "", only: set[str] | None = None) -> tuple[str, str]:
        """(text, chain) of least description length; the chain is empty if the text stays as it is.

        used: chains already paid for. only: the chains to be tried, None for all. before: the text in front, measured along, as short stretches alone are hardly compressed.
        """
        polish = "pl" in languages  # its letters are out of place elsewhere only
        wide, strange = (_UNCLEAN, _UNCLEAN) if polish else (_gate(tuple(sorted(languages))), _SUSPECT)
        seen = {text: ""}
        level = {text: ""}
        for chain in sorted(only or ()):
            seen.setdefault(_redo(text, chain), chain)
        step = 0
        while level and only is None:  # every further reading of UTF-8 is shorter than what it was read from, so this ends
            nxt = {}
            for t, chain in level.items():
                for name, r in _steps(t, step == 0):
                    if r not in seen:
                        seen[r] = nxt[r] = f"{chain}+{name}" if chain else name
            step += 1
            level = {t: c for t, c in nxt.items() if c.count("<") == c.count("utf-8<")}  # only readings of UTF-8 repeat
            if step >= ALL_STEPS and level:
                t = min(level, key=lambda t: (self.bits(before + t, languages), t))
                level = {t: level[t]}
        bad, odd = len(wide.findall(text)), len(strange.findall(text))
        # single-byte readings, not yet paid for, that explain no character out of place
        idle = lambda t, c: only is None and "utf-" not in c and len(wide.findall(t)) >= bad and not (odd and len(strange.findall(t)) < odd)
        if not self.every:
            seen = {t: c for t, c in seen.items() if not c or not idle(t, c)}
        if len(seen) == 1:
            return text, ""
        capitals = len(_CAPITAL.findall(text)) > len(_SMALL.findall(text))
        known = len(_ALIEN.findall(text))
        meant = frozenset(e for k in languages | _script(text) for e in MEANT.get(k, ("cp1252",)))
        spoken = languages | _script("\n".join(seen))  # the same for all readings, as a dictionary may know a phrase of another language
        cost = lambda t: self.bits(before + t, spoken, capitals) + (self.odd_bits * len(strange.findall(t)) if self.odd_bits else 0)
        least = (cost(text), 0, "", text)
        for t, c in seen.items():
            if c and len(_ALIEN.findall(t)) <= known:  # what was meant holds no more controls and foreign letters than what was read
                bits = cost(t) + (AGAIN_BITS if c in used else _cost(c, meant))
                if (bits, c.count("+") + 1, c, t) < least:
                    if idle(t, c):  # which of all readings it is has to be told as well
                        bits += IDLE_BITS + math.log2(len(seen))
                    least = min(least, (bits, c.count("+") + 1, c, t))
        return least[3:1:-1]


def _redo(text: str, chain: str) -> str:
    """text with the steps of a chain applied, whatever they make of it."""
    for name in chain.split("+"):
        right, wrong = name.split("<", 1)
        if right == "utf-8" and wrong.startswith("lower("):
            up = _unfolded(text)
            r = _as_utf8(wrong[6:-1], up)
            text = r if r != up else text
        elif wrong.startswith("utf-16-"):
            text = _narrow(wrong[7:], right, text)
        else:
            text = _as_utf8(wrong, text) if right == "utf-8" else text.translate(_table(wrong, right))
    return text


_ALIEN = re.compile(f"[^\x00-\x7f{_ALPHABET}ąćęłńśźżĄĆĘŁŃŚŹŻ\u0300-\u0303\u0308\u030a\u030c\u0327\u0328Ͱ-Ͽ]")
_CAPITAL, _SMALL = re.compile("[A-Z]"), re.compile("[a-z]")


def _cost(chain: str, meant: frozenset[str]) -> int:
    """Bits that tell a chain: its steps, and for a single-byte one whether its encoding is one that the languages are written in."""
    bits, steps = 0, chain.split("+")
    for k, step in enumerate(steps):
        right = step.split("<")[0]
        if right == "utf-8":
            bits += (REPEAT_BITS + (0 if step == steps[k - 1] else SWITCH_BITS)) if k else UTF8_BITS
        else:
            bits += SINGLE_BITS + (0 if right in meant else OLD_BITS if right in OLD else FOREIGN_BITS)
    return bits


_LETTERS = {"el": re.compile("[Ͱ-Ͽ]"), "pl": re.compile("[ąćęłńśźżĄĆĘŁŃŚŹŻ]")}


def _script(text: str) -> set[str]:
    return {k for k, letters in _LETTERS.items() if letters.search(text)}


_SENTENCE = re.compile(r"[^\n.;]*[\n.;]+\s*|[^\n.;]+")


def restore(text: str, judge: Judge, lang: str | None = None) -> tuple[str, str, list[str], int]:
    """(status, restored text, chains, stretches changed). status: CLEAN, RESTORED, or UNRESTORABLE if undecodable bytes were replaced."""
    lost = "�" in text
    pieces = _SENTENCE.findall(text)
    languages = {k for k in (lang, judge.language(text)) if k}
    odd = _UNCLEAN if "pl" in languages else _gate(tuple(sorted(languages)))
    chains: list[str] = []
    changed: set[int] = set()
    # stretches with something odd first; then again, and all others that aren't plain ASCII, as the document's own chains cost next to nothing where
    # something is odd; then with chains that came up since, until none does
    tried: set[str] = set()
    for turn in count():
        paid = set(chains)
        new = paid - tried if turn > 1 else paid
        for k, s in enumerate(pieces):
            plain = not odd.search(s)
            if not plain or new and k not in changed and not s.isascii():
                t, chain = judge.best(s, languages, set() if plain else paid, pieces[k - 1] if k and len(s) < SHORT else "", new if plain or turn > 1 else None)
                if chain:
                    changed.add(k)
                    chains.append(chain)
                    pieces[k] = t
        tried = paid
        if set(chains) <= tried and (turn or not chains):
            break
    status = "UNRESTORABLE" if lost else "RESTORED" if changed else "CLEAN"
    return status, "".join(pieces), chains, len(changed)


def train_dictionaries(documents: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", docs_per_language: int = 300, size: int = 1 << 16, max_languages: int = 32, max_chars: int = 100_000) -> dict[str, bytes]:
    """A dictionary per language from about docs_per_language whole documents of it without suspicious characters, chosen by hash of the id.

    The sample is bounded by docs_per_language x max_languages documents of at most max_chars each, whatever the corpus's size. Languages too small for a dictionary have none.
    """
    import zstandard

    counts = documents.where(F.col(lang).isNotNull()).groupBy(lang).count().orderBy(F.desc("count"), lang).limit(max_languages).collect()
    if not counts:
        return {}
    every = F.lit(1)
    for r in counts:
        every = F.when(F.col(lang) == r[0], max(1, r[1] // docs_per_language)).otherwise(every)
    chosen = documents.where((F.length(text) <= max_chars) & F.col(lang).isin([r[0] for r in counts]) & (F.pmod(F.xxhash64(doc_id), every) == 0) & ~F.col(text).rlike(UNCLEAN))
    samples: dict[str, list[bytes]] = {}
    for l, t in chosen.select(lang, text).collect():
        if t:
            samples.setdefault(l, []).extend(s.encode("utf-8", "ignore") for s in _SENTENCE.findall(t) if len(s) > 20)
    out = {}
    for l, s in samples.items():
        s.sort()
        try:
            out[l] = zstandard.train_dictionary(min(size, max(2048, sum(map(len, s)) // 4)), s, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            continue
    return out


def repair(documents: DataFrame, dictionaries: dict[str, bytes], *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """Per document with a garbled stretch: (doc_id, status, chains, n_stretches, restored).

    status is RESTORED, or UNRESTORABLE where replacement characters show that bytes were lost (what can be restored is). Documents without garbled
    stretch give no row; null and empty texts and null ids are clean; repeated rows give one row; no dictionaries: lengths in plain bytes decide.
    Whole texts are scanned in the JVM; only those with a suspicious character, or one that the told language doesn't use, go to Python.
    """
    reach_package(documents.sparkSession)
    passes = F.when(F.col(lang).isin("pl", "el"), F.col(text).rlike(SUSPICIOUS))
    for l in USED:
        passes = passes.when(F.col(lang) == l, F.col(text).rlike(gate((l,))))
    few = documents.where(passes.otherwise(F.col(text).rlike("[^\\x00-\\x7f]"))).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")).where("doc_id is not null")

    def run(batches):
        judge = Judge(dictionaries)
        for pdf in batches:
            rows = []
            for d, l, t in zip(pdf["doc_id"].tolist(), pdf["lang"].tolist(), pdf["text"].tolist()):
                status, fixed, chains, n = restore(t, judge, l)
                if status != "CLEAN":
                    rows.append((d, status, ",".join(sorted(set(chains))), n, fixed))
            yield pd.DataFrame(rows, columns=["doc_id", "status", "chains", "n_stretches", "restored"])

    return few.mapInPandas(run, RESULT)


def is_suspicious(text: Column | str) -> Column:
    return F.col(text).rlike(SUSPICIOUS) if isinstance(text, str) else text.rlike(SUSPICIOUS)

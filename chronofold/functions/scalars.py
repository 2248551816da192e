"""Scalar functions as column expressions; they stay inside the JVM but for normalization forms."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_key(key: Column | str) -> Column:
    """Keys as they are compared: stray blanks and capitals of typed references don't count."""
    return F.lower(F.trim(_c(key)))


def nfkc(text: Column | str) -> Column:
    """Compatibility form with plain blanks; no built-in exists, so Arrow batches."""

    @F.pandas_udf("string")
    def norm(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).replace(" ", " "))

    return norm(text)


def decimal_literal(text: Column | str) -> Column:
    """Spanish decimal literal (1.234,56) as decimal(38,10); null where it is none."""
    return F.replace(F.translate(_c(text), " .", ""), F.lit(","), F.lit(".")).try_cast("decimal(38,10)")


def integer_literal(text: Column | str) -> Column:
    """Integer with thousands points; null unless all digits."""
    digits = F.translate(_c(text), ". ", "")
    return F.when(digits.rlike("^[0-9]+$"), digits.try_cast("bigint"))


def iso_date_text(text: Column | str) -> Column:
    """dd/MM/yyyy as ISO text, impossible dates kept as typed; null if the text has another form."""
    c = _c(text)
    return F.when(c.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.regexp_replace(c, "^([0-9]{2})/([0-9]{2})/([0-9]{4})$", "$3-$2-$1"))


def date_literal(text: Column | str) -> Column:
    """dd/MM/yyyy as date; impossible dates are null."""
    return iso_date_text(text).try_cast("date")


def is_number(text: Column | str) -> Column:
    return _c(text).rlike("^[0-9]{1,3}([.][0-9]{3})*(,[0-9]+)?$|^[0-9]+(,[0-9]+)?$")


def is_percentage(text: Column | str) -> Column:
    return _c(text).rlike("^[0-9]{1,3}(,[0-9]+)?( ?%)?$")


#: A ticked box and any box: brackets with any one mark, as the forms have x, v and tick signs, or with none; and the signs for boxes.
TICKED, BOX = "\\[\\s*[^\\]\\s]\\s*\\]|[\u2611\u2612]", "\\[\\s*[^\\]\\s]?\\s*\\]|[\u2610\u2611\u2612]"


def checkbox(text: Column | str) -> Column:
    """A box with any mark true, an empty one false, else null."""
    return F.when(_c(text).rlike(BOX), _c(text).rlike(TICKED))


def html_clean(text: Column | str) -> Column:
    """Tags out, the five named entities and blanks decoded, white space collapsed."""
    c = F.regexp_replace(_c(text), "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(c, "[\\s ]+", " "))


def html_links(text: Column | str) -> Column:
    return F.regexp_extract_all(_c(text), F.lit("href=\"([^\"]+)\""), F.lit(1))


def alternative_identifier(ident: Column | str) -> Column:
    """The other spelling of a tax number: with or without the hyphen after its letter."""
    c = _c(ident)
    return F.when(c.contains("-"), F.replace(c, F.lit("-"), F.lit(""))).otherwise(F.concat(F.substring(c, 1, 1), F.lit("-"), F.expr("substring({}, 2)".format(ident)) if isinstance(ident, str) else c.substr(F.lit(2), F.length(c))))


def party_kind(name: Column | str) -> Column:
    """LEGAL_PERSON by legal-form suffix, NATURAL_PERSON otherwise, null for no name."""
    c = _c(name)
    return F.when(c.isNull(), None).when(c.rlike("(?i)(^|[ ,])(s\\.? ?a\\.?u?|s\\.? ?l\\.?u?|s\\.?i\\.?c\\.?a\\.?v|gmbh|ltd|limited|plc|llp|inc|incorporated|b\\.? ?v|n\\.? ?v)\\.?$"), "LEGAL_PERSON").otherwise("NATURAL_PERSON")


def split_related(text: Column | str) -> tuple[Column, Column]:
    """(person, position): split at the first ' - ', else at the first ', '."""
    c = _c(text)
    cut = F.when(c.contains(" - "), F.split(c, " - ", 2)).otherwise(F.split(c, ", ", 2))
    return F.trim(F.get(cut, F.lit(0))), F.trim(F.get(cut, F.lit(1)))


def outside_venue(code: Column | str) -> Column:
    """TRUE off venue, FALSE for a market code, UNKNOWN otherwise."""
    c = _c(code)
    return F.when(c.isin("XOFF", "XXXX"), "TRUE").when(c.rlike("^[A-Z0-9]{4}$"), "FALSE").otherwise("UNKNOWN")


def nature(text: Column | str) -> Column:
    """Exact map only; anything else stays null."""
    return F.when(_c(text) == "Compra", "BUY").when(_c(text) == "Venta", "SELL")


def operation_flag(text: Column | str) -> Column:
    return F.when(_c(text) == "A", "ACQUISITION").when(_c(text) == "T", "DISPOSAL")


def fingerprint(text: Column | str, trees, default: str = "UNKNOWN") -> Column:
    """The first template of trees (name, needed, avoided) whose needed parts the text holds, any alternative of "a|b", and whose avoided ones it doesn't.

    A null text has the default.
    """
    c, out = _c(text), F.lit(default)
    for name, need, avoid in reversed(trees):
        hit = F.lit(True)
        for part in need:
            some = [c.contains(x) for x in part.split("|")]
            hit = hit & reduce(lambda x, y: x | y, some)
        for part in avoid:
            hit = hit & ~c.contains(part)
        out = F.when(hit, name).otherwise(out)
    return F.when(c.isNull(), F.lit(default)).otherwise(out)


def regime(surface: Column | str, filing_date: Column | str) -> Column:
    s, d = _c(surface), _c(filing_date)
    return (
        F.when(s == "nod", "MAR_2018_NOD").when(s == "nod_legacy", "PRE_2018_LEGACY")
        .when(s.isin("ps", "ac") & (d >= F.lit(S.NEW_FORM_FROM).cast("date")), "CIRC2_2022").when(s.isin("ps", "ac") & d.isNotNull(), "RD1362_2007_CIRC8_2015").otherwise("UNKNOWN")
    )


def doc_scope(surface: Column | str, filing_date: Column | str) -> Column:
    """Whether the documents of a notice are read: nod always, legacy never, the others from a day on."""
    s, d = _c(surface), _c(filing_date)
    return F.when(s == "nod", True).when(s.isin("ps", "ac"), F.coalesce(d >= F.lit(S.DOCUMENTS_FROM).cast("date"), F.lit(False))).otherwise(False)


def canonical_text(**parts: Column) -> Column:
    """Canonical JSON text of the parts in alphabetical order, nulls kept; the input of every identity hash."""
    ordered = [parts[k].cast("string").alias(k) for k in sorted(parts)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def identity(**parts: Column) -> Column:
    return F.sha2(canonical_text(**parts), 256)


def feed_item_id(item_key: Column | str) -> Column:
    return F.concat(F.lit("v1:"), F.substring(F.sha2(F.concat(F.lit("feed/v1|"), _c(item_key)), 256), 1, 32))


def blob_path(sha: Column | str, extension: str) -> Column:
    s = _c(sha)
    return F.concat(F.substring(s, 1, 2), F.lit("/"), F.substring(s, 3, 2), F.lit("/"), s, F.lit("." + extension))


def base64url(text: Column | str) -> Column:
    return F.translate(F.base64(_c(text).cast("binary")), "+/", "-_")


def half_ulp(literal: Column | str) -> Column:
    """Half a unit of the last decimal place of a Spanish literal, as decimal(38,10)."""
    places = F.coalesce(F.length(F.get(F.split(_c(literal), ","), F.lit(1))), F.lit(0))
    table = F.array(*[F.lit("0.5" if k == 0 else "0." + "0" * k + "5").cast("decimal(38,10)") for k in range(10)])
    return F.get(table, F.least(places, F.lit(9)))


def nearest_band(x: Column, anchors: list[float], tolerance: float = 42.0) -> Column:
    """Index of the nearest column anchor within tolerance, else null; of equals the leftmost."""
    best = F.array_min(F.array(*[F.struct(F.abs(x - F.lit(float(a))).alias("d"), F.lit(i).alias("i")) for i, a in enumerate(anchors)]))
    return F.when(best["d"] <= tolerance, best["i"])

"""Registry listings: pages of blocks, history tables and statements to notices and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X

# What marks the parts of a listing block.
BLOCK = "repListaPrincipal_ctl[0-9]+_elementoPrimerNivel"
FIELDS = {
    "filing_raw": "liFechaRegistro[^>]*>\\s*([0-9/]+)", "issuer_nif_seen": "datosentidad\\.aspx\\?nif=([A-Z0-9-]+)", "declarant_raw": "Declarante:\\s*([^<\\n]+)", "role_raw": "Motivo de la notificaci[oó]n:\\s*([^<\\n]+)",
    "doc_token": "verdocumento/ver\\?e=([^\"&']+)", "registration": "Número de registro:\\s*([0-9]+)", "rectifies": "(?i)rectifica a nº de registro:\\s*([0-9]+)", "rectified_by": "(?i)rectificada por nº de registro:\\s*([0-9]+)",
}


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))


def listing_blocks(pages: DataFrame) -> DataFrame:
    """(url, block) of pages (url, html): one row per first-level block."""
    return pages.select("url", F.explode(F.slice(F.split("html", BLOCK), F.lit(2), F.size(F.split("html", BLOCK)))).alias("block"))


def listing_notices(pages: DataFrame) -> DataFrame:
    """Blocks with a registration number as notices of the nod surface; statuses by their rectification marks."""
    b = listing_blocks(pages)
    f = b.select("url", *[_found(F.col("block"), p).alias(k) for k, p in FIELDS.items()]).where("registration is not null")
    status = F.when(F.col("rectifies").isNotNull(), "RECTIFIES").when(F.col("rectified_by").isNotNull(), "RECTIFIED").otherwise("ACTIVE")
    return f.select(
        F.concat(F.lit("nod:"), "registration").alias("notice_key"), F.lit("nod").alias("source_surface"), F.col("registration").alias("source_registration_number"), "issuer_nif_seen", X.date_literal("filing_raw").alias("filing_date"),
        X.html_clean("declarant_raw").alias("declarant_name_raw"), X.html_clean("role_raw").alias("declarant_role"), "doc_token", status.alias("notice_status"), "rectifies", "rectified_by", F.col("url").alias("source_url_observed"),
    )


def listing_relations(notices: DataFrame) -> DataFrame:
    """Both readings of the rectification marks as RECTIFIES edges, once each."""
    a = notices.where("rectifies is not null").select(F.col("notice_key").alias("annulling_key"), F.concat(F.lit("nod:"), "rectifies").alias("annulled_key"), F.col("source_url_observed").alias("evidence_url"))
    b = notices.where("rectified_by is not null").select(F.concat(F.lit("nod:"), "rectified_by").alias("annulling_key"), F.col("notice_key").alias("annulled_key"), F.col("source_url_observed").alias("evidence_url"))
    return a.unionByName(b).groupBy("annulling_key", "annulled_key").agg(F.min("evidence_url").alias("evidence_url")).withColumn("relation_type", F.lit("RECTIFIES"))


def annulment_statements(pages: DataFrame, surface: str) -> DataFrame:
    """'registration X ... annuls Y of dd/mm/yyyy' as ANNULS edges; a page without the statement gives none."""
    t = X.html_clean("html")
    annulling = _found(t, "registro de entrada\\s*([0-9]{9,10})\\s*anula")
    targets = F.regexp_extract_all(t, F.lit("([0-9]{9,10})\\s*de\\s*[0-9]{2}/[0-9]{2}/[0-9]{4}"), F.lit(1))
    rows = pages.select("url", annulling.alias("a"), F.explode(targets).alias("t")).where("a is not null")
    return rows.select(F.concat(F.lit(surface + ":"), "a").alias("annulling_key"), F.concat(F.lit(surface + ":"), "t").alias("annulled_key"), F.lit("ANNULS").alias("relation_type"), F.col("url").alias("evidence_url")).distinct()


def history_rows(pages: DataFrame, surface: str, table_id: str = "gridNotifAnt") -> DataFrame:
    """Rows of a history table: cells in order, registration number, document token and filing date. Nested tables are not looked into."""
    body = F.regexp_extract("html", f"(?s)<table[^>]*{table_id}[^>]*>(.*?)</table>", 1)
    rows = pages.select("url", F.posexplode(F.regexp_extract_all(body, F.lit("(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_index", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit("(?s)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: X.html_clean(c))
    reg = F.coalesce(_found(F.col("row"), "(?i)registro\\s*([0-9]{9,10})"), _found(F.col("row"), "Abrir PDF de\\s*(?:[^ ]+\\s)*?([0-9]{9,10})"))
    out = rows.select("url", "row_index", cells.alias("cells"), reg.alias("registration"), _found(F.col("row"), "verdocumento/ver\\?e=([^\"&']+)").alias("doc_token"), X.date_literal(F.regexp_extract("row", "([0-9]{2}/[0-9]{2}/[0-9]{4})", 1)).alias("filing_date"))
    return out.where("registration is not null").withColumn("notice_key", F.concat(F.lit(surface + ":"), "registration"))


def query_links(pages: DataFrame, page: str) -> DataFrame:
    """(url, link) of the braced query links to a page, first occurrence order lost, each once."""
    links = F.regexp_extract_all("html", F.lit(page + "\\.aspx\\?qS=\\{[^}]*\\}"), F.lit(0))
    return pages.select("url", F.explode(F.transform(links, lambda u: F.replace(F.replace(u, F.lit("{"), F.lit("%7B")), F.lit("}"), F.lit("%7D")))).alias("link")).distinct()


def issuer_identity(pages: DataFrame) -> DataFrame:
    """(url, nif, lei, capital_raw) from a general-data page's labelled cells."""
    label = lambda k: _found(F.col("html"), f"data-th=[\"']{k}[\"'][^>]*>\\s*([^<]*)")
    return pages.select("url", label("NIF").alias("nif"), label("LEI").alias("lei"), label("Capital social vigente").alias("capital_raw")).where("nif is not null")


def recent_issuers(pages: DataFrame) -> DataFrame:
    """Tax numbers named by a page of recent filings: hints of where to look."""
    return pages.select(F.explode(F.regexp_extract_all("html", F.lit("ps_ac_ini\\.aspx\\?nif=([A-Z0-9-]+)"), F.lit(1))).alias("nif")).distinct()


def split_by_universe(notices: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Notices of known issuers, hyphens in tax numbers disregarded, and the issuers found beyond the universe."""
    plain = lambda c: F.replace(F.col(c), F.lit("-"), F.lit(""))
    known = universe.select("issuer_id", plain("nif").alias("_nif")).distinct()
    n = notices.withColumn("_nif", plain("issuer_nif_seen"))
    inside = n.join(known, "_nif").drop("_nif")
    outside = n.where("_nif is not null").join(known, "_nif", "left_anti").select(F.col("_nif").alias("nif")).distinct()
    return inside, outside

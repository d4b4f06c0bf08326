"""Metadata of harvested records and what web pages and issue lists say: parsing with expressions over columns."""

from __future__ import annotations

import html as html_module

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T

SPANISH = ("es", "esp", "spa", "spanish", "español", "espanol")


def is_spanish(language: Column) -> Column:
    """The language is Spanish or a regional form; null and blank are not."""
    plain = F.lower(T.strip(language))
    return F.coalesce(plain.isin(*SPANISH) | plain.rlike("^es[-_]"), F.lit(False))


def is_article(kind: Column) -> Column:
    """A type that names an article; a null type may be one."""
    plain = F.lower(T.strip(kind))
    return F.coalesce(F.contains(plain, F.lit("article")) | F.contains(plain, F.lit("artículo")) | F.contains(plain, F.lit("articulo")), F.lit(True))


def _holds(part: str):
    """A predicate of one argument (a second would be taken for the position)."""
    return lambda c: F.contains(F.lower(c), F.lit(part))


def web_addresses(identifiers: Column) -> Column:
    return F.filter(F.transform(identifiers, T.strip), lambda i: i.rlike("^https?://"))


def pdf_address(identifiers: Column) -> Column:
    """The first web address that ends in .pdf (also before a query) or asks for a PDF script."""
    return F.get(F.filter(web_addresses(identifiers), lambda i: i.rlike("(?i)\\.pdf($|\\?)") | F.contains(i, F.lit("script=sci_pdf"))), F.lit(0))


def article_address(identifiers: Column) -> Column:
    """The first web address that asks for an article's text; else the first that names the library; else the first."""
    every = web_addresses(identifiers)
    text = F.get(F.filter(every, lambda i: F.contains(i, F.lit("script=sci_arttext"))), F.lit(0))
    return F.coalesce(text, F.get(F.filter(every, _holds("scielo")), F.lit(0)), F.get(every, F.lit(0)))


def candidate_pdf(address: Column) -> Column:
    """The PDF address that an article's address leads to, if its query has a pid: each name of the query once, without empty
    ones, and the script that gives PDF files."""
    pairs = F.filter(F.split(F.parse_url(address, F.lit("QUERY")), "&"), lambda p: p.rlike("^[^=]+=."))
    name = lambda p: F.split_part(p, F.lit("="), F.lit(1))
    names = F.transform(pairs, name)
    first = F.filter(pairs, lambda p, i: F.array_position(names, name(p)) == i + 1)
    scripted = F.transform(first, lambda p: F.when(name(p) == "script", F.lit("script=sci_pdf")).otherwise(p))
    whole = F.when(F.array_contains(names, "script"), scripted).otherwise(F.array_append(scripted, F.lit("script=sci_pdf")))
    parts = F.regexp_extract(address, "^([^?#]*)", 1), F.regexp_extract(address, "(#.*)$", 1)
    return F.when(F.array_contains(names, "pid"), F.concat(parts[0], F.lit("?"), F.array_join(whole, "&"), parts[1]))


def issues(df: DataFrame, key: str, column: str, trimmed: bool = True) -> DataFrame:
    """Rows (key, year, volume, number, issue_id, start, end) of a list such as 2020-10-2-N-77-1>>>2019-...

    Years are parted by >>>; after the year come groups of exactly five fields. Years of fewer than six fields are left out, and,
    where fields are trimmed, issues without an id.
    """
    years = df.select(key, F.explode(F.split(column, ">>>")).alias("one")).withColumn("fields", F.split("one", "-")).where(F.size("fields") >= 6)
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size("fields") - 1) / 5).cast("int") - 1), lambda i: F.slice("fields", i * 5 + 2, 5))
    each = years.select(key, F.get("fields", F.lit(0)).alias("year"), F.explode(groups).alias("f"))
    field = lambda i: T.strip(F.get("f", F.lit(i))) if trimmed else F.get("f", F.lit(i))
    out = each.select(key, (T.strip(F.col("year")) if trimmed else F.col("year")).alias("year"), *(field(i).alias(n) for i, n in enumerate(("volume", "number", "kind", "issue_id", "position"))))
    return out.where("issue_id != ''") if trimmed else out


def oai_records(df: DataFrame, column: str = "xml") -> DataFrame:
    """Adds the fields of an OAI-PMH record in XML; deleted ones, and those without an identifier or metadata, have none.

    Elements are taken by pattern, so that one bad record can't stop a job; the first title, language, type and date hold. The
    PDF's address is the first among the identifiers or, if there is none, the one that the article's address leads to.
    """
    x = F.col(column)
    header = F.regexp_extract(x, "(?s)<(?:\\w+:)?header\\b.*?</(?:\\w+:)?header>", 0)
    body = F.regexp_extract(x, "(?s)<(?:\\w+:)?metadata\\b.*?</(?:\\w+:)?metadata>", 0)

    def every(part: Column, tag: str) -> Column:
        found = F.regexp_extract_all(part, F.lit(f"(?s)<(?:\\w+:)?{tag}(?:\\s[^>]*)?>(.*?)</(?:\\w+:)?{tag}>"), F.lit(1))
        return F.filter(F.transform(found, _unescaped), lambda v: v != "")

    first = lambda part, tag: F.get(every(part, tag), F.lit(0))
    deleted = header.rlike("<(?:\\w+:)?header[^>]*status=\"deleted\"")
    known = ~deleted & first(header, "identifier").isNotNull() & F.contains(body, F.lit(":dc"))
    of = lambda c: F.when(known, c)
    out = df.withColumns({
        "deleted": deleted, "identifier": of(first(header, "identifier")), "oai_datestamp": of(first(header, "datestamp")), "title": of(first(body, "title")), "authors": of(every(body, "creator")),
        "language": of(F.lower(first(body, "language"))), "resource_type": of(F.lower(first(body, "type"))), "publication_date": of(first(body, "date")), "identifiers": of(every(body, "identifier")),
        "subjects": of(every(body, "subject")), "rights": of(every(body, "rights")), "descriptions": of(every(body, "description")),
    })
    out = out.withColumn("article_url", article_address(F.col("identifiers")))
    return out.withColumn("pdf_url", F.coalesce(pdf_address(F.col("identifiers")), candidate_pdf(F.col("article_url"))))


def _unescaped(c: Column) -> Column:
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return T.strip(c)


def file_sums(df: DataFrame, column: str = "listing") -> DataFrame:
    """Rows (filename, sum) of a checksum listing: lines of a hash and a name, with or without an asterisk."""
    line = df.select(F.explode(T.lines(F.col(column))).alias("line")).select(F.split(T.strip(F.col("line")), "\\s+\\*?", 2).alias("parts"))
    return line.where("size(parts) = 2").select(F.get("parts", F.lit(1)).alias("filename"), F.lower(F.get("parts", F.lit(0))).alias("sum"))


def newest_snapshot(html: Column) -> Column:
    return F.array_max(F.regexp_extract_all(html, F.lit('href="(\\d{8})/"'), F.lit(1)))


# web pages


def pdf_link(html: Column) -> Column:
    found = F.regexp_extract(html, "(?i)https?://[^\\s\"'<>]+\\.pdf", 0)
    return F.when(found != "", found)


def citation_pdf(html: Column, fallback: Column) -> Column:
    """The address in the citation_pdf_url meta element, else the fallback."""
    found = F.regexp_extract(html, "<meta[^>]*name=\"citation_pdf_url\"[^>]*content=\"([^\"]*)\"", 1)
    return F.coalesce(F.nullif(T.strip(found), F.lit("")), fallback)


def link_ids(html: Column, pattern: str = "articulo\\.oa\\?id=([0-9]+)") -> Column:
    """Distinct ids in links that the pattern matches, sorted."""
    links = F.regexp_extract_all(html, F.lit("href=\"([^\"]*)\""), F.lit(1))
    ids = F.flatten(F.transform(links, lambda l: F.regexp_extract_all(l, F.lit(pattern), F.lit(1))))
    return F.array_sort(F.array_distinct(ids))


def script_sources(html: Column, domain: str, excluded: tuple[str, ...] = ()) -> Column:
    """Addresses of scripts of the page's own domain, without excluded ones."""
    found = F.filter(F.transform(F.regexp_extract_all(html, F.lit("<script[^>]*\\ssrc=\"([^\"]*)\""), F.lit(1)), T.strip), lambda s: s != "")
    whole = F.transform(found, lambda s: F.when(s.rlike("^https?://"), s).when(s.startswith("//"), F.concat(F.lit("https:"), s)).otherwise(F.concat(F.lit(f"https://{domain}/"), F.regexp_replace(s, "^/+", ""))))
    kept = F.filter(whole, lambda s: F.contains(s, F.lit(domain)))
    for part in excluded:
        holds = _holds(part)
        kept = F.filter(kept, lambda s: ~holds(s))  # noqa: B023
    return kept


@F.pandas_udf(StringType())
def resolved(texts: pd.Series) -> pd.Series:
    """Character references as the characters they stand for."""
    return texts.map(lambda t: html_module.unescape(t) if t is not None and "&" in t else t)


def visible_text(html: Column) -> Column:
    """What a reader sees: no scripts, styles and tags, references resolved, single blanks."""
    bare = F.regexp_replace(html, "(?is)<(script|style|noscript)\\b.*?</\\1\\s*>|<!--.*?-->", " ")
    bare = resolved(F.regexp_replace(bare, "(?s)<[^>]*>", " "))
    return T.strip(F.regexp_replace(bare, f"[{T.WS}]+", " "))


def keyword_lines(df: DataFrame, key: str, html: str, keywords: list[str], size: int = 500) -> DataFrame:
    """Rows (key, line_no, line): lines that hold a keyword in any case, with single blanks, cut at `size`."""
    each = df.select(key, F.posexplode(T.lines(F.col(html))).alias("i", "raw"))
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.contains(F.lower("raw"), F.lit(k.lower()))
    return each.where(hit).select(key, (F.col("i") + 1).cast("long").alias("line_no"), F.substring(T.strip(F.regexp_replace("raw", f"[{T.WS}]+", " ")), 1, size).alias("line"))


def linked_ids(df: DataFrame, key: str, html: str, patterns: list[str]) -> DataFrame:
    """Rows (key, id, label): ids of links by any of the patterns with the text of the first link that has each."""
    anchor = F.regexp_extract_all(F.col(html), F.lit("(?s)<a\\s[^>]*href=\"[^\"]*\"[^>]*>.*?</a>"), F.lit(0))
    each = df.select(key, F.posexplode(anchor).alias("i", "a")).withColumn("href", F.regexp_extract("a", "href=\"([^\"]*)\"", 1))
    found = F.lit(None).cast("string")
    for p in patterns:
        found = F.coalesce(found, F.nullif(F.regexp_extract("href", p, 1), F.lit("")))
    rows = each.withColumn("id", found).where("id is not null").withColumn("label", visible_text(F.col("a")))
    return rows.groupBy(key, "id").agg(F.min(F.struct("i", "label")).alias("f")).select(key, "id", F.col("f.label").alias("label"))


def numbered_ids(df: DataFrame, key: str, html: str, patterns: list[str]) -> DataFrame:
    """Rows (key, linked, only_in_html, all_ids): ids of links, ids that stand only elsewhere in the page, and how many ids there
    are; ids in the order of their numbers."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit("(?i)<a\\s[^>]*href=\"([^\"]*)\""), F.lit(1))
    first_in = lambda p: lambda h: F.slice(F.regexp_extract_all(h, F.lit(f"(?i){p}"), F.lit(1)), 1, 1)
    of_links = [F.flatten(F.transform(hrefs, first_in(p))) for p in patterns]
    of_page = [F.regexp_extract_all(F.col(html), F.lit(f"(?i){p}"), F.lit(1)) for p in patterns]
    by_number = lambda ids: F.transform(F.array_sort(F.transform(F.array_distinct(ids), lambda i: F.struct(i.cast("decimal(38,0)").alias("n"), i.alias("i")))), lambda s: s["i"])
    linked, every = F.concat(*of_links), F.concat(*of_page)
    return df.select(
        key, by_number(linked).alias("linked"), by_number(F.array_except(every, linked)).alias("only_in_html"), F.size(F.array_union(every, linked)).cast("long").alias("all_ids"),
    )

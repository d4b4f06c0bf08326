"""Wikitext: plain text of articles, and what categories, dates and markup say of them.

Un-nested markup goes by expressions inside the JVM. Templates, links and tables nest, so the cleaner itself is a scanner in an
Arrow function, one pass over each text for each level.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import text as T

# Countries by name, months, and names of templates: those without text, those that give their last value, those that
# give all their values; tags that are dropped with what they hold.
COUNTRIES = {
    "Argentina": "AR",
    "Bolivia": "BO",
    "Brasil": "BR",
    "Chile": "CL",
    "Colombia": "CO",
    "Costa Rica": "CR",
    "Cuba": "CU",
    "Ecuador": "EC",
    "El Salvador": "SV",
    "España": "ES",
    "Estados Unidos": "US",
    "Guatemala": "GT",
    "Honduras": "HN",
    "México": "MX",
    "Nicaragua": "NI",
    "Panamá": "PA",
    "Paraguay": "PY",
    "Perú": "PE",
    "Puerto Rico": "PR",
    "República Dominicana": "DO",
    "Uruguay": "UY",
    "Venezuela": "VE",
}
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
SILENT = {
    "rp", "refn", "harvnp", "harvtxt", "sfn", "sfnp", "sfnref", "listaref", "referencias", "control de autoridades", "commonscat", "commons category", "portal", "portal asociado", "otros usos", "otro uso",
    "redirige aquí", "redirige aqui", "distinguir", "desambiguación", "desambiguacion", "wikcionario", "wikisource", "wikiquote", "wikilibros", "wikiviajes",
}
SILENT_HEADS = ("ficha", "infobox", "cita ", "cita_", "cite ", "cite_")
LAST_VALUE = {"lang", "lang-es", "lang-en", "lang-la", "nombre original", "transl", "transliteration"}
CENTURIES = {"siglo", "siglo2"}
JOINED = {"ipa", "afi", "unidad", "convertir", "formatnum", "esd", "fecha", "fecha de inicio", "fecha de fin"}
NO_TEXT_LINKS = ("archivo:", "file:", "imagen:", "image:", "categoría:", "categoria:", "category:")
DROPPED = "gallery|math|source|syntaxhighlight|timeline|imagemap|score|mapframe|maplink|ref|references"

CLEANED = StructType([StructField("text", StringType()), StructField("original_characters", LongType()), StructField("cleaned_characters", LongType()), StructField("reduction_ratio", DoubleType())])


def without_tables(text: str) -> str:
    """Tables, with those inside them, become a line end each; a text with unbalanced ones stays as it is."""
    out, depth, last = [], 0, 0
    for m in re.finditer(r"\{\||\|\}", text):
        if m[0] == "{|":
            if depth == 0:
                out.append(text[last : m.start()])
            depth += 1
        else:
            depth -= 1
            if depth < 0:
                return text
            if depth == 0:
                out.append("\n")
                last = m.end()
    return text if depth else "".join([*out, text[last:]])


def _template(inner: str) -> str:
    """The text that a template leaves: by its name, or its only value."""
    head, *rest = inner.split("|")
    name = head.strip().lower()
    values = [v for v in (p.partition("=")[2].strip() if "=" in p else p.strip() for p in rest) if v]
    if name in SILENT or name.startswith(SILENT_HEADS):
        return ""
    if name in JOINED:
        return " ".join(values)
    if name in CENTURIES:
        return f"siglo {values[0]}" if values else ""
    if name in LAST_VALUE or len(values) == 1:
        return values[-1] if values else ""
    return ""


def _link(m: re.Match) -> str:
    target, _, label = m[1].partition("|")
    if target.strip().lower().startswith(NO_TEXT_LINKS):
        return ""
    return label.rpartition("|")[2].strip() or target.partition("#")[0].strip()


def plain(text: str, passes: int = 5) -> str:
    """The text of an article; of templates within templates up to `passes` levels are resolved."""
    text = re.sub(r"(?s)<!--.*?-->", "", without_tables(text))
    text = re.sub(rf"(?is)<({DROPPED})\b[^>]*/>", "", text)
    text = re.sub(rf"(?is)<({DROPPED})\b[^>]*>.*?</\1\s*>", "", text)
    for _ in range(passes):
        shorter = re.sub(r"\{\{([^{}]*)\}\}", lambda m: _template(m[1]), text)
        if shorter == text:
            break
        text = shorter
    for _ in range(passes):
        shorter = re.sub(r"\[\[([^\[\]]*)\]\]", _link, text)
        if shorter == text:
            break
        text = shorter
    text = re.sub(r"\[(?:https?:)?//[^\s\]]+(?:\s+([^\]]*))?\]", lambda m: m[1] or "", text)
    text = html.unescape(re.sub(r"<[^<>]*>", "", text)).replace("[[", " ").replace("]]", " ")
    text = re.sub(r"'{2,5}", "", text)
    lines = []
    for line in text.splitlines():
        line = re.sub(r"^\s*[*#:;]+\s*", "", line)
        line = re.sub(r"^\s*={2,6}\s*(.*?)\s*={2,6}\s*$", r"\1", line)
        line = " ".join(line.split())
        if line:
            lines.append(line)
    return "\n".join(lines)


@F.pandas_udf(CLEANED)
def cleaned(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        if t is None:
            rows.append((None, 0, 0, 0.0))
            continue
        try:
            out = plain(t)
        except Exception:  # a text that breaks the scanner loses its tables only
            out = without_tables(t)
        rows.append((out, len(t), len(out), max(0, len(t) - len(out)) / len(t) if t else 0.0))
    return pd.DataFrame(rows, columns=CLEANED.names)


def categories(c: Column) -> Column:
    """Distinct names of categories, sorted without regard to case."""
    found = F.regexp_extract_all(c, F.lit("(?iu)\\[\\[\\s*categor[íi]a\\s*:\\s*([^\\]|]+)"), F.lit(1))
    names = F.array_distinct(F.filter(F.transform(found, lambda x: T.strip(F.regexp_replace(x, f"[{T.WS}]+", " "))), lambda x: x != ""))
    return F.transform(F.array_sort(F.transform(names, lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))), lambda s: s["v"])


def countries(names: Column) -> Column:
    """Codes of the countries that are categories, sorted."""
    known = F.create_map(*[F.lit(x) for name, code in COUNTRIES.items() for x in (name.lower(), code)])
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda n: F.element_at(known, F.lower(n))), lambda x: x.isNotNull())))


def publication_date(c: Column) -> Column:
    """yyyy-mm-dd of a date template, of its three values or of its written form; null unless the day is 1 to 31."""
    three = "(?iu)\\{\\{\\s*fecha\\s*\\|\\s*(\\d{1,2})\\s*\\|\\s*([a-záéíóú]+)\\s*\\|\\s*(\\d{4})\\s*\\}\\}"
    written = "(?iu)\\{\\{\\s*fecha\\s*\\|\\s*(\\d{1,2})\\s+de\\s+([a-záéíóú]+)\\s+de\\s+(\\d{4})\\s*\\}\\}"

    def of(pattern: str) -> Column:
        month = F.replace(F.translate(F.lower(F.regexp_extract(c, pattern, 2)), "áéíóú", "aeiou"), F.lit("setiembre"), F.lit("septiembre"))
        number = F.array_position(F.array(*map(F.lit, MONTHS)), month)
        day = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("int")
        return F.when(day.between(1, 31) & (number > 0), F.format_string("%s-%02d-%02d", F.regexp_extract(c, pattern, 3), number, day))

    return F.coalesce(of(three), of(written))


# What counts as one of each kind of markup, by its opening alone and as a whole construct.
OPENINGS = {
    "internal_links": "\\[\\[", "external_links": "\\[(?:https?://)", "templates": "\\{\\{", "references": "(?i)<ref\\b", "tables": "\\{\\|", "headings": "(?m)^={2,6}[^=\n].*?={2,6}\\s*$",
    "categories": "(?iu)\\[\\[\\s*Categor[ií]a\\s*:", "files": "(?iu)\\[\\[\\s*(?:Archivo|File|Imagen)\\s*:", "html_comments": "<!--", "math_tags": "(?i)<math\\b",
}
CONSTRUCTS = {
    "internal_links": "\\[\\[[^\\]]+\\]\\]", "templates": "(?s)\\{\\{.*?\\}\\}", "references": "(?is)<ref\\b[^>]*>.*?</ref\\s*>|<ref\\b[^>]*/\\s*>", "headings": "(?m)^={2,6}.*?={2,6}\\s*$",
    "external_links": "\\[(?:https?|ftp)://[^\\s\\]]+", "files": "(?iu)\\[\\[\\s*(?:Archivo|File|Imagen|Image)\\s*:", "html_comments": "(?s)<!--.*?-->", "tables": "\\{\\|",
}


def features(c: Column, kinds: dict[str, str] = OPENINGS) -> dict[str, Column]:
    """Counts of each kind of markup, by OPENINGS or as CONSTRUCTS."""
    return {name: F.regexp_count(c, F.lit(p)).cast("long") for name, p in kinds.items()}


def has_date_template(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)\\{\\{\\s*(?:fecha|date)\\s*\\|"), F.lit(False))


def is_redirect(text: Column, tag: Column, way: str = "tag") -> Column:
    """Whether a page only leads to another one: by its tag; by its tag or the text's head ("text"); or with any white space
    before the sign ("pattern")."""
    by_tag = tag.isNotNull()
    if way == "tag":
        return by_tag
    head = F.lower(F.regexp_replace(text, f"^[{T.WS}]+", "")).startswith("#redirec") & F.lower(F.regexp_replace(text, f"^[{T.WS}]+", "")).rlike("^#redirec(?:t|ción)")
    return by_tag | F.coalesce(head if way == "text" else text.rlike("(?iu)^\\s*#(?:REDIRECT|REDIRECCIÓN)"), F.lit(False))


def _blank(c: Column) -> Column:
    return F.coalesce(T.strip(c), F.lit("")) == ""


def scanned(pages: DataFrame, dump: str = "wikipedia") -> DataFrame:
    """Rows of a dump's pages (see sources.xml_pages) with outcome: why a page is left out, or 'article' with its plain text.

    An encyclopedia's dump ("wikipedia") is tested for: another namespace, a redirect by its tag, a blank text, a text of which
    nothing is left, a missing id. A news dump ("wikinews") is tested for: another namespace, a redirect by tag or text, a blank
    text, a missing id, a text of which nothing is left; its articles also have date, categories and countries. All tests but that
    of the cleaned text come before the cleaner, which sees no other pages.
    """
    other = F.coalesce("ns", F.lit(-1)) != 0
    early = F.when(other, "other namespace").when(is_redirect(F.col("text"), F.col("redirect"), "text" if dump == "wikinews" else "tag"), "redirect").when(_blank(F.col("text")), "blank")
    if dump == "wikinews":
        early = early.when(F.col("page_id").isNull(), "no id")
    judged = pages.withColumn("outcome", early)
    last = F.when(F.col("c.text") == "", "empty").when(F.col("page_id").isNull(), "no id").otherwise("article")
    rest = judged.where("outcome is null").withColumn("c", cleaned("text")).withColumn("outcome", last)
    rest = rest.select(*pages.columns, "outcome", F.when(F.col("outcome") == "article", F.col("c.text")).alias("plain"), F.col("c.reduction_ratio").alias("reduction_ratio"))
    out = judged.where("outcome is not null").withColumn("plain", F.lit(None).cast("string")).withColumn("reduction_ratio", F.lit(None).cast("double")).unionByName(rest)
    if dump != "wikinews":
        return out
    of_article = lambda c: F.when(F.col("outcome") == "article", c)
    names = categories(F.col("text"))
    return out.withColumns({"publication_date": of_article(publication_date(F.col("text"))), "categories": of_article(names), "geographic_scope": of_article(countries(names))})


def countries_mentioned(names: Column) -> Column:
    """Codes of the countries whose name stands anywhere in a category, sorted."""
    holds = lambda part: lambda n: F.contains(F.lower(n), F.lit(part))
    found = [F.when(F.exists(names, holds(k.lower())), F.lit(code)) for k, code in COUNTRIES.items()]
    return F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())))


def outcomes(scan: DataFrame) -> DataFrame:
    """Of scanned pages: by outcome, their number and the lengths and reductions of their texts."""
    n = F.length("text")
    whole = F.try_divide(F.sum(n - F.length("plain")).cast("double"), F.sum(F.when(F.col("plain").isNotNull(), n)))
    return scan.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("pages"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.avg(n).alias("average"),
        whole.alias("reduction"), F.min("reduction_ratio").alias("least_reduction"), F.max("reduction_ratio").alias("greatest_reduction"),
    )


def namespaces(pages: DataFrame) -> DataFrame:
    return pages.groupBy("ns").agg(F.count(F.lit(1)).alias("pages"), F.count_if(is_redirect(F.col("text"), F.col("redirect"), "pattern")).alias("redirects"))


def top_categories(pages: DataFrame, most: int = 100) -> DataFrame:
    """The most frequent categories, ties by name."""
    each = pages.select(F.explode(categories(F.col("text"))).alias("category"))
    return each.groupBy("category").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category").limit(most)


def content_counters(pages: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row: pages, articles and what leads to none, lengths of articles, how many have categories or a date template, and the
    sums of CONSTRUCTS. The counters of an analysis of a whole dump, by one aggregate."""
    namespace = F.coalesce("ns", F.lit(-1)) == 0
    empty, leads = F.coalesce("text", F.lit("")) == "", is_redirect(F.col("text"), F.col("redirect"), "text")
    article = namespace & ~empty & ~leads
    of = lambda c: F.when(article, c)
    has = F.size(categories(F.col("text"))) > 0
    sums = [F.coalesce(F.sum(of(c)), F.lit(0)).alias(f"{n}_total") for n, c in features(F.col("text"), CONSTRUCTS).items()]
    n = F.length("text")
    return pages.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(namespace).alias("namespace_zero"), F.count_if(namespace & empty).alias("empty_text"), F.count_if(namespace & ~empty & leads).alias("redirects"),
        F.count_if(article).alias("articles"), F.sum(of(n)).cast("long").alias("characters"), F.min(of(n)).cast("long").alias("shortest"), F.max(of(n)).cast("long").alias("longest"),
        F.count_if(article & has).alias("with_categories"), F.count_if(article & ~has).alias("without_categories"), F.count_if(article & has_date_template(F.col("text"))).alias("with_date_template"), *sums,
    )


def country_counts(pages: DataFrame) -> DataFrame:
    """Rows (country, articles): articles with a category that holds the country's name."""
    found = pages.select(F.explode(countries_mentioned(categories(F.col("text")))).alias("country"))
    return found.groupBy("country").agg(F.count(F.lit(1)).alias("articles"))

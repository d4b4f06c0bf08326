"""More queries of the operators, each with SQL: dumps, harvests, classification, recovery, sinks that are read back, scalars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import classify, corpus, lexicon, metadata, quality, recovery, wikitext
from ..session import scratch, spread, table
from ..sources import files, sinks
from .queries import FORMS_SQL, FREQ_SQL, RWORD, RWS, canonical_sql, ranked_sql, strip_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# wikitext whose markup varies by document

TEMPLATES = [
    "{{rp|12}}", "{{sfn|García|2001}}", "{{wikcionario|sol}}", "{{nombre original|ca|Principat}}", "{{lang|la|agri}}", "{{siglo|XX}}", "{{unidad|12|km}}", "{{IPA|a|b}}", "{{Ficha de persona|nombre=x}}", "{{cita web|t}}",
    "{{cita_libro|t}}", "{{única|valor}}", "{{doble|uno|dos}}", "{{clave|k=solo}}", "{{fecha de fin|1|mayo}}", "{{fecha límite|hoy}}", "{{transl|ru|da}}", "{{nota|{{lang|fr|pain}}}}", "{{commons_category|x}}", "{{formatnum|1000}}",
]
# What is left of each, as the rules of the templates say.
LEFT = ["", "", "", "Principat", "agri", "siglo XX", "12 km", "a b", "", "", "", "valor", "", "solo", "1 mayo", "hoy", "da", "pain", "x", "1000"]
NAMES = ["Brasil", "España", "Guinea Ecuatorial", "Ciencia", "México", "Historia de Chile", "Perú"]
MARKED = "CASE WHEN doc_id % {} = {} THEN {} ELSE {} END"


def _literal(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _picked(values: list[str], by: str = "doc_id") -> Column:
    return F.get(F.array(*map(F.lit, values)), (F.col(by) % len(values)).cast("int"))


# pages of a dump: text, redirects, blanks, namespaces and missing ids by doc_id; the sentence is the first 60 letters of the text
BODY_SQL = f"""body AS (SELECT doc_id, 'T ' || doc_id AS title, CASE WHEN doc_id % 5 = 0 THEN 4 ELSE 0 END AS ns, CASE WHEN doc_id % 17 <> 0 THEN doc_id END AS page_id, CASE WHEN doc_id % 7 = 0 THEN 'Otro' END AS redirect, {_literal(NAMES)}[doc_id % 7 + 1] AS name,
 regexp_replace(coalesce(text, ''), '[^a-zA-Z]+', ' ', 'g')[:60] AS words, doc_id % 20 + 1 AS k FROM documents),
page AS (SELECT *, CASE WHEN doc_id % 11 = 0 THEN '  ' WHEN doc_id % 13 = 0 THEN '  #REDIRECCIÓN [[Sol]]' WHEN doc_id % 19 = 0 THEN '<!-- nada -->' ELSE
 '{{{{fecha|' || (doc_id % 33) || CASE WHEN doc_id % 2 = 0 THEN '|marzo|2005}}}}' ELSE ' de setiembre de 2010}}}}' END || chr(10) || '''''''' || words || '''''''' || ' <ref name="a">nota</ref>x' || {_literal(TEMPLATES)}[k] || 'y' || chr(10) || '[[Categoría:' || name || '|z]] [[categoria:  Ciencia   pura]] [[Sol#ra|el sol]] [https://a.b c d]' || chr(10)
 || '== Sección ==' || chr(10) || '* punto' || chr(10) || '{{| t {{| u |}} v |}}' || chr(10) || 'fin<math>x</math>.' END AS wikitext FROM body)"""
PLAIN_SQL = f"""concat_ws(chr(10), concat_ws(' ', doc_id % 33, CASE WHEN doc_id % 2 = 0 THEN 'marzo 2005' ELSE 'de setiembre de 2010' END), trim(regexp_replace(words || ' x', ' +', ' ', 'g') || {_literal(LEFT)}[k] || 'y'), 'el sol c d', 'Sección', 'punto', 'fin.')"""


def _wikitext() -> Column:
    d = F.col("doc_id")
    date = F.concat(F.lit("{{fecha|"), (d % 33).cast("string"), F.when(d % 2 == 0, "|marzo|2005}}").otherwise(" de setiembre de 2010}}"))
    article = F.concat(
        date, F.lit("\n'''"), F.col("words"), F.lit("''' <ref name=\"a\">nota</ref>x"), _picked(TEMPLATES), F.lit("y\n[[Categoría:"), _picked(NAMES), F.lit("|z]] [[categoria:  Ciencia   pura]] [[Sol#ra|el sol]] [https://a.b c d]\n"),
        F.lit("== Sección ==\n* punto\n{| t {| u |} v |}\nfin<math>x</math>."),
    )
    return F.when(d % 11 == 0, "  ").when(d % 13 == 0, "  #REDIRECCIÓN [[Sol]]").when(d % 19 == 0, "<!-- nada -->").otherwise(article)


def _wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    rows = spread(_documents(spark, sf_dir).select("doc_id", F.substring(F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-zA-Z]+", " "), 1, 60).alias("words")))
    return rows.select(
        "doc_id", F.concat(F.lit("T "), "doc_id").alias("title"), F.when(d % 5 == 0, 4).otherwise(0).alias("ns"), F.when(d % 17 != 0, d).alias("page_id"), F.when(d % 7 == 0, "Otro").alias("redirect"), _wikitext().alias("text"),
    )


@query(f"WITH {BODY_SQL} SELECT doc_id, CASE WHEN doc_id % 11 = 0 OR doc_id % 19 = 0 AND doc_id % 13 <> 0 THEN '' WHEN doc_id % 13 = 0 THEN '#REDIRECCIÓN Sol' ELSE {PLAIN_SQL} END AS text, length(wikitext)::BIGINT AS original_characters FROM page".replace("'#REDIRECCIÓN Sol'", "'REDIRECCIÓN Sol'"))
def wikitext_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wiki_pages(spark, sf_dir).select("doc_id", wikitext.cleaned("text").alias("c")).select("doc_id", "c.text", "c.original_characters")


OUTCOME_SQL = "CASE WHEN ns <> 0 THEN 'other namespace' WHEN redirect IS NOT NULL {} THEN 'redirect' WHEN doc_id % 11 = 0 THEN 'blank' {} WHEN doc_id % 19 = 0 AND doc_id % 13 <> 0 THEN 'empty' {} ELSE 'article' END"


@query(f"WITH {BODY_SQL}, o AS (SELECT *, {OUTCOME_SQL.format('', '', 'WHEN page_id IS NULL THEN $$no id$$')} AS outcome FROM page) SELECT title, outcome, CASE WHEN outcome = 'article' THEN CASE WHEN doc_id % 13 = 0 THEN 'REDIRECCIÓN Sol' ELSE {PLAIN_SQL} END END AS plain FROM o")
def encyclopedia_dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as an XML dump, read again and scanned."""
    return wikitext.scanned(_dump(spark, sf_dir), "wikipedia").select("title", "outcome", "plain")


def _dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(
        F.lit("<page><title>"), escaped(F.col("title")), F.lit("</title><ns>"), F.col("ns").cast("string"), F.lit("</ns>"), F.coalesce(F.concat(F.lit("<id>"), F.col("page_id").cast("string"), F.lit("</id>")), F.lit("")),
        F.coalesce(F.concat(F.lit('<redirect title="'), escaped(F.col("redirect")), F.lit('" />')), F.lit("")), F.lit('<revision><text xml:space="preserve">'), escaped(F.col("text")), F.lit("</text></revision></page>"),
    )
    at, pages = scratch(spark), _wiki_pages(spark, sf_dir).select("doc_id", page.alias("page"))
    dumps = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, pages.count() // 500))).alias("dump")  # of some 500 pages each
    whole = F.concat(F.lit("<mediawiki>\n"), F.array_join(F.collect_list("page"), "\n"), F.lit("\n</mediawiki>"))
    pages.groupBy(dumps).agg(whole.alias("value")).write.partitionBy("dump").text(at)
    return files.xml_pages(spark, at)


@query(f"""WITH {BODY_SQL}, o AS (SELECT *, {OUTCOME_SQL.format('OR doc_id % 13 = 0 AND doc_id % 11 <> 0', 'WHEN page_id IS NULL THEN $$no id$$', '')} AS outcome FROM page)
SELECT title, outcome, CASE WHEN outcome = 'article' AND doc_id % 33 BETWEEN 1 AND 31 THEN CASE WHEN doc_id % 2 = 0 THEN '2005-03-' ELSE '2010-09-' END || printf('%02d', (doc_id % 33)::INT) END AS publication_date,
 CASE WHEN outcome = 'article' THEN array_to_string(list_sort(['Ciencia pura', name], 'ASC'), '|') END AS categories,
 CASE WHEN outcome = 'article' THEN CASE name WHEN 'Brasil' THEN 'BR' WHEN 'España' THEN 'ES' WHEN 'México' THEN 'MX' WHEN 'Perú' THEN 'PE' ELSE '' END END AS countries FROM o""")
def news_dump_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = wikitext.scanned(_dump(spark, sf_dir), "wikinews")
    return scan.select("title", "outcome", "publication_date", F.array_join("categories", "|").alias("categories"), F.array_join("geographic_scope", "|").alias("countries"))


@query(f"""WITH {BODY_SQL}, a AS (SELECT *, ns = 0 AS z, (redirect IS NOT NULL OR doc_id % 13 = 0 AND doc_id % 11 <> 0) AS r, NOT (doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 19 = 0) AS whole FROM page)
SELECT count(*)::BIGINT AS pages, count(*) FILTER (z)::BIGINT AS namespace_zero, count(*) FILTER (z AND r)::BIGINT AS redirects, count(*) FILTER (z AND NOT r)::BIGINT AS articles, sum(length(wikitext)) FILTER (z AND NOT r)::BIGINT AS characters,
 min(length(wikitext)) FILTER (z AND NOT r)::BIGINT AS shortest, max(length(wikitext)) FILTER (z AND NOT r)::BIGINT AS longest, count(*) FILTER (z AND NOT r AND whole)::BIGINT AS with_categories, count(*) FILTER (z AND NOT r AND NOT whole)::BIGINT AS without_categories,
 count(*) FILTER (z AND NOT r AND whole)::BIGINT AS with_date_template, (3 * count(*) FILTER (z AND NOT r AND whole))::BIGINT AS internal_links_total, count(*) FILTER (z AND NOT r AND whole)::BIGINT AS references_total, count(*) FILTER (z AND NOT r AND whole)::BIGINT AS headings_total,
 count(*) FILTER (z AND NOT r AND whole)::BIGINT AS external_links_total, 0::BIGINT AS files_total, count(*) FILTER (z AND NOT r AND doc_id % 19 = 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0)::BIGINT AS html_comments_total, (2 * count(*) FILTER (z AND NOT r AND whole))::BIGINT AS tables_total,
 (2 * count(*) FILTER (z AND NOT r AND whole))::BIGINT AS templates_total FROM a""")
def dump_content_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wikitext.content_counters(_wiki_pages(spark, sf_dir)).drop("empty_text")


@query(f"""WITH {BODY_SQL}, c AS (SELECT *, NOT (doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 19 = 0) AS whole FROM page) SELECT doc_id, whole::BIGINT AS headings, (2 * whole::BIGINT) AS tables, whole::BIGINT AS refs, whole::BIGINT AS math_tags, (2 * whole::BIGINT) AS categories, whole::BIGINT AS external_links,
 (CASE WHEN whole THEN 2 + (k = 18)::BIGINT ELSE 0 END)::BIGINT AS openings, (CASE WHEN whole THEN 2 ELSE 0 END)::BIGINT AS constructs, (3 * whole::BIGINT + (doc_id % 13 = 0 AND doc_id % 11 <> 0)::BIGINT) AS internal_links FROM c""")
def wiki_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings of markup, and whole templates beside opened ones, which differ where templates nest."""
    o, c = wikitext.features(F.col("text")), wikitext.features(F.col("text"), wikitext.CONSTRUCTS)
    return _wiki_pages(spark, sf_dir).select(
        "doc_id", o["headings"].alias("headings"), o["tables"].alias("tables"), o["references"].alias("refs"), o["math_tags"].alias("math_tags"), o["categories"].alias("categories"), o["external_links"].alias("external_links"),
        o["templates"].alias("openings"), c["templates"].alias("constructs"), o["internal_links"].alias("internal_links"),
    )


@query(f"""WITH {BODY_SQL} SELECT doc_id, redirect IS NOT NULL AS by_tag, redirect IS NOT NULL OR (doc_id % 13 = 0 AND doc_id % 11 <> 0) AS by_text, redirect IS NOT NULL OR (doc_id % 13 = 0 AND doc_id % 11 <> 0) AS by_pattern FROM page""")
def wiki_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    ways = [wikitext.is_redirect(F.col("text"), F.col("redirect"), w).alias(f"by_{w}") for w in ("tag", "text", "pattern")]
    return _wiki_pages(spark, sf_dir).select("doc_id", *ways)


@query(f"""WITH {BODY_SQL}, c AS (SELECT unnest(CASE WHEN name = 'Historia de Chile' THEN ['CL'] WHEN name = 'Brasil' THEN ['BR'] WHEN name = 'España' THEN ['ES'] WHEN name = 'México' THEN ['MX'] WHEN name = 'Perú' THEN ['PE'] ELSE [] END) AS country FROM page WHERE NOT (doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 19 = 0))
SELECT country, count(*)::BIGINT AS articles FROM c GROUP BY country""")
def wiki_country_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wikitext.country_counts(_wiki_pages(spark, sf_dir))


@query(f"WITH {BODY_SQL}, o AS (SELECT *, {OUTCOME_SQL.format('', '', 'WHEN page_id IS NULL THEN $$no id$$')} AS outcome FROM page) SELECT outcome, count(*)::BIGINT AS pages, min(length(wikitext))::BIGINT AS shortest, max(length(wikitext))::BIGINT AS longest, avg(length(wikitext)) AS average FROM o GROUP BY outcome")
def dump_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wikitext.outcomes(wikitext.scanned(_wiki_pages(spark, sf_dir), "wikipedia"))
    return rows.select("outcome", "pages", F.col("shortest").cast("long").alias("shortest"), F.col("longest").cast("long").alias("longest"), "average")


@query(f"WITH {BODY_SQL} SELECT ns, count(*)::BIGINT AS pages, count(*) FILTER (redirect IS NOT NULL OR (doc_id % 13 = 0 AND doc_id % 11 <> 0))::BIGINT AS redirects FROM page GROUP BY ns")
def dump_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wikitext.namespaces(_wiki_pages(spark, sf_dir))


# harvested records as XML, addresses, files and sums

RECORDS_SQL = """r0 AS (SELECT DISTINCT identifier, oai_datestamp, title, authors, language, resource_type, publication_date, subjects, descriptions FROM remote_record WHERE identifier IS NOT NULL AND title IS NOT NULL),
r AS (SELECT *, hash(identifier) AS h, try_cast(regexp_extract(identifier, '[0-9]+$') AS BIGINT) AS n FROM r0)"""


def _oai(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as XML: some deleted, some with an address of a PDF file, some of an article alone, by the number in the identifier."""
    r = table(spark, sf_dir, "remote_record").where("identifier is not null and title is not null")
    r = r.select("identifier", "oai_datestamp", "title", "authors", "language", "resource_type", "publication_date", "subjects", "descriptions").distinct()
    r = r.withColumn("n", F.try_to_number(F.regexp_extract("identifier", "[0-9]+$", 0), F.lit("999999999999999")).cast("long"))
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    one = lambda tag, c: F.coalesce(F.concat(F.lit(f"<dc:{tag}>"), esc(c), F.lit(f"</dc:{tag}>")), F.lit(""))
    many = lambda tag, c: F.coalesce(F.array_join(F.transform(c, lambda v: F.concat(F.lit(f"<dc:{tag}>"), esc(v), F.lit(f"</dc:{tag}>"))), ""), F.lit(""))
    addresses = F.when(F.col("n") % 3 == 0, F.array(F.lit("doi:1"), F.lit("http://www.scielo.org/a?script=sci_arttext&pid=S1&lng=&tlng=es"))).when(F.col("n") % 3 == 1, F.array(F.lit("https://x.org/1.PDF?d=1"), F.lit("https://SciELO.org/x")))
    xml = F.concat(
        F.lit("<record><header"), F.when(F.col("n") % 10 == 0, ' status="deleted"').otherwise(""), F.lit("><identifier>"), F.col("identifier"), F.lit("</identifier><datestamp>"), F.coalesce("oai_datestamp", F.lit("")), F.lit("</datestamp></header><metadata><oai_dc:dc>"),
        one("title", F.col("title")), many("creator", F.col("authors")), one("language", F.col("language")), one("type", F.col("resource_type")), one("date", F.col("publication_date")), many("identifier", addresses), many("subject", F.col("subjects")),
        many("description", F.col("descriptions")), F.lit("<dc:rights>libre</dc:rights></oai_dc:dc></metadata></record>"),
    )
    return r.select(F.col("identifier").alias("key"), F.coalesce("oai_datestamp", F.lit("")).alias("at"), F.col("n"), xml.alias("xml"))


def _kept(c: str) -> str:
    return f"list_filter(list_transform(coalesce({c}, []), lambda v: {strip_sql('v')}), lambda v: v <> '')"


@query(f"""WITH {RECORDS_SQL}, k AS (SELECT *, coalesce(n % 10 <> 0, true) AS live, n % 3 AS m FROM r)
SELECT identifier AS key, coalesce(oai_datestamp, '') AS at, NOT live AS deleted, CASE WHEN live THEN nullif({strip_sql('title')}, '') END AS title, CASE WHEN live THEN array_to_string({_kept('authors')}, '|') END AS authors, CASE WHEN live THEN nullif(lower({strip_sql('language')}), '') END AS language,
 CASE WHEN live THEN nullif(lower({strip_sql('resource_type')}), '') END AS resource_type, CASE WHEN live THEN array_to_string({_kept('subjects')}, '|') END AS subjects, CASE WHEN live THEN len({_kept('descriptions')})::INT END AS descriptions, CASE WHEN live THEN 'libre' END AS rights,
 CASE WHEN live AND m = 0 THEN 'http://www.scielo.org/a?script=sci_arttext&pid=S1&lng=&tlng=es' WHEN live AND m = 1 THEN 'https://SciELO.org/x' END AS article_url, CASE WHEN live AND m = 0 THEN 'http://www.scielo.org/a?script=sci_pdf&pid=S1&tlng=es' WHEN live AND m = 1 THEN 'https://x.org/1.PDF?d=1' END AS pdf_url FROM k""")
def oai_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = metadata.oai_records(_oai(spark, sf_dir))
    return r.select(
        "key", "at", "deleted", "title", F.array_join("authors", "|").alias("authors"), "language", "resource_type", F.array_join("subjects", "|").alias("subjects"), F.size("descriptions").alias("descriptions"),
        F.array_join("rights", "|").alias("rights"), "article_url", "pdf_url",
    ).withColumn("descriptions", F.when(~F.col("deleted"), F.col("descriptions")))


@query("""SELECT DISTINCT doc_id, 'md5' || doc_id || '  *a' || doc_id || '.bz2' AS listing, CASE WHEN doc_id % 4 = 0 THEN 'missing' WHEN doc_id % 4 = 1 THEN 'wrong' ELSE 'equal' END AS verdict, '2024' || printf('%04d', (doc_id % 9 + 100)::INT) AS snapshot FROM documents""".replace("'md5' || doc_id || '  *a' || doc_id || '.bz2' AS listing, ", ""))
def checked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files against the sums of a published listing: equal, wrong, or not listed; and the newest snapshot of a directory page."""
    d = _documents(spark, sf_dir).select("doc_id", "text").distinct()
    name = F.concat(F.lit("a"), F.col("doc_id").cast("string"), F.lit(".bz2"))
    file = d.select("doc_id", name.alias("filename"), F.sha1(F.encode("text", "UTF-8")).alias("actual"))
    listing = d.where("doc_id % 4 != 0").select(F.concat(F.upper(F.when(F.col("doc_id") % 4 == 1, F.sha1(F.lit(b"x"))).otherwise(F.sha1(F.encode("text", "UTF-8")))), F.lit("  *"), name, F.lit("\n\nbad")).alias("listing"))
    joined = file.join(metadata.file_sums(listing), "filename", "left")
    verdict = F.when(F.col("sum").isNull(), "missing").when(F.col("sum") == F.col("actual"), "equal").otherwise("wrong")
    page = F.concat(F.lit('<a href="20230101/">a</a><a href="2024'), F.format_string("%04d", (F.col("doc_id") % 9 + 100).cast("int")), F.lit('/">b</a><a href="99999999">c</a>'))
    return joined.select("doc_id", verdict.alias("verdict"), metadata.newest_snapshot(page).alias("snapshot"))


@query("""SELECT doc_id, list_sort([doc_id % 100, 7]::BIGINT[])[1]::VARCHAR AS first, CASE WHEN doc_id % 100 = 7 THEN 1 ELSE 2 END::BIGINT AS linked, CASE WHEN 1000 + doc_id % 3 IN (7, doc_id % 100) THEN '' ELSE (1000 + doc_id % 3)::VARCHAR END AS only_in_html, (CASE WHEN doc_id % 100 = 7 THEN 2 ELSE 3 END)::BIGINT AS all_ids, 'Uno ' || doc_id AS label FROM documents""")
def journal_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that links and scripts of a page name by three forms of addresses, in numeric order, and the text of their links."""
    d = _documents(spark, sf_dir).select("doc_id")
    number = (F.col("doc_id") % 100).cast("string")
    html = F.concat(F.lit('<a href="revista.oa?id='), number, F.lit('"><b>Uno</b> '), F.col("doc_id").cast("string"), F.lit('</a> <A class="x" href="x?idRevista=7">Siete</A> <a href="revista.oa?id='), number, F.lit('">Dos</a> <script>cveRevista="'), (1000 + F.col("doc_id") % 3).cast("string"), F.lit('"</script>'))
    patterns = ["revista\\.oa\\?id=(\\d+)", "idRevista=(\\d+)", "cveRevista[=:\"']+(\\d+)"]
    rows = d.withColumn("html", html)
    ids = metadata.numbered_ids(rows, "doc_id", "html", patterns)
    labels = metadata.linked_ids(rows, "doc_id", "html", patterns[:1]).select("doc_id", "label")
    out = ids.join(labels, "doc_id")
    return out.select("doc_id", F.get("linked", F.lit(0)).alias("first"), F.size("linked").cast("long").alias("linked"), F.array_join("only_in_html", ",").alias("only_in_html"), "all_ids", "label")


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Señal &amp; ruido — «x» €' ELSE 'Año & <b>' END AS expected, 'Tit ' || doc_id || ' ' || CASE WHEN doc_id % 2 = 0 THEN 'Señal &amp; ruido — «x» €' ELSE 'Año & <b>' END AS text FROM documents""".replace("CASE WHEN doc_id % 2 = 0 THEN 'Señal &amp; ruido — «x» €' ELSE 'Año & <b>' END AS expected, ", ""))
def html_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("doc_id") % 2 == 0, "Se&ntilde;al &amp;amp; ruido &mdash; &laquo;x&raquo;&nbsp;&euro;").otherwise("A&#241;o &amp; &lt;b&gt;")
    html = F.concat(F.lit("<style>p {}</style><h1>Tit "), F.col("doc_id").cast("string"), F.lit("</h1>\n<script>if (a < b) { }</script><p>"), body, F.lit("</p><!-- no --><noscript>no</noscript>"))
    return _documents(spark, sf_dir).select("doc_id", metadata.visible_text(html).alias("text"))


@query("""SELECT doc_id, nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN 'v' || doc_id ELSE '' END, '') AS scalar, 'Ana; Luis ' || doc_id AS names, 'https://w/' || replace(replace(replace(replace(url_encode('Año_' || (doc_id % 50) || '_(a/b)_~*''c'), '%28', '('), '%29', ')'), '%27', ''''), '*', '%2A') AS quoted, 'https://w/Año_' || (doc_id % 50) AS plain,
 printf('%02d:%02d:%02d', ((doc_id * 7) // 3600)::INT, (((doc_id * 7) // 60) % 60)::INT, ((doc_id * 7) % 60)::INT) AS elapsed, CASE WHEN doc_id < 1024 THEN printf('%.2f B', doc_id::DOUBLE) WHEN doc_id < 1048576 THEN printf('%.2f KiB', doc_id / 1024.0::DOUBLE) ELSE printf('%.2f MiB', doc_id / 1048576.0::DOUBLE) END AS size FROM documents""")
def scalar_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = F.col("doc_id"), F.col("doc_id").cast("string")
    value = F.when(d % 3 == 0, " NULL ").when(d % 3 == 1, F.concat(F.lit(" v"), n)).otherwise(" ")
    title = F.concat(F.lit("Año "), (d % 50).cast("string"))
    return _documents(spark, sf_dir).select(
        "doc_id", T.scalar(value).alias("scalar"), F.array_join(T.names(F.concat(F.lit(" Ana, ,Luis "), n, F.lit(" ,"))), "; ").alias("names"),
        T.page_url("https://w/", F.concat(title, F.lit(" (a/b) ~*'c")), quoted=True).alias("quoted"), T.page_url("https://w/", title).alias("plain"), T.human_seconds(d * 7).alias("elapsed"), T.human_bytes(d).alias("size"),
    )


@query("""SELECT doc_id, 'https://a.org/x?' || CASE doc_id % 4 WHEN 0 THEN 'script=sci_pdf&pid=S' || doc_id || '&tlng=es' WHEN 1 THEN 'pid=S' || doc_id || '&script=sci_pdf#top' WHEN 2 THEN 'pid=1&script=sci_pdf' END AS pdf FROM documents""")
def pdf_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    address = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("https://a.org/x?script=sci_abstract&pid=S"), n, F.lit("&lng=&tlng=es"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("https://a.org/x?pid=S"), n, F.lit("#top")))
        .when(F.col("doc_id") % 4 == 2, F.lit("https://a.org/x?pid=1&pid=2&script=a&script=b")).otherwise(F.lit("https://a.org/x?id=3"))
    )
    return _documents(spark, sf_dir).select("doc_id", metadata.candidate_pdf(address).alias("pdf"))


# classification, thresholds, recovery

LAST_SQL = "last AS (SELECT local_path, title, authors FROM (SELECT *, row_number() OVER (PARTITION BY local_path ORDER BY oai_datestamp DESC NULLS LAST, identifier DESC, title DESC NULLS LAST, authors DESC NULLS LAST) AS rn FROM (SELECT * FROM remote_record WHERE acquisition_status IN ('DOWNLOADED') AND coalesce(local_path, '') <> '')) WHERE rn = 1)"
STEM_SQL = "regexp_replace(regexp_extract(d.original_path, '[^/]*$'), '(.)\\.[^.]*$', '\\1')"


def _classified(kind: str, domain: str, document_type: str, author: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = table(spark, sf_dir, "document").where("original_path is not null").select("document_id", "original_path").distinct()
        return classify.from_records(documents, classify.downloaded(table(spark, sf_dir, "remote_record")), kind, ["oai_datestamp", "identifier"])

    run.__name__ = f"classified_{kind}"
    query(f"""WITH {LAST_SQL} SELECT d.document_id, 'es' AS language, '{domain}' AS thematic_domain, '{document_type}' AS document_type, coalesce(nullif(l.title, ''), {STEM_SQL}) AS title, {author} AS author, l.local_path IS NOT NULL AS recorded
 FROM (SELECT DISTINCT document_id, original_path FROM document WHERE original_path IS NOT NULL) d LEFT JOIN last l ON l.local_path = d.original_path""")(run)


_classified("scientific", "cientifico", "articulo_cientifico", "nullif(array_to_string(l.authors, '; '), '')")
_classified("encyclopedia", "general", "articulo_enciclopedico", "NULL::VARCHAR")
_classified("news", "general", "articulo_prensa", "NULL::VARCHAR")


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'El ingenioso hidalgo don Quijote de la Mancha' WHEN 1 THEN 'La vida de Lazarillo de Tormes y de sus fortunas y adversidades' WHEN 2 THEN 'El burlador de Sevilla y convidado de piedra' WHEN 3 THEN 'La Celestina' WHEN 4 THEN 'Propio' ELSE 'otra obra.v' || doc_id END AS title,
 CASE doc_id % 6 WHEN 0 THEN 'Miguel de Cervantes Saavedra' WHEN 1 THEN 'Anónimo' WHEN 2 THEN 'Atribuido a Tirso de Molina' WHEN 3 THEN 'Fernando de Rojas' END AS author, CASE doc_id % 6 WHEN 0 THEN 'novela' WHEN 1 THEN 'novela_picaresca' WHEN 2 THEN 'obra_dramatica' WHEN 3 THEN 'obra_dialogada' ELSE 'obra_literaria' END AS document_type,
 CASE doc_id % 6 WHEN 0 THEN 'novela' WHEN 1 THEN 'novela' WHEN 2 THEN 'obra_dialogada' WHEN 3 THEN 'obra_dialogada' ELSE 'default' END AS profile FROM documents""")
def known_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literary files: known works by a part of their names, the first in order where two are named."""
    n = F.col("doc_id").cast("string")
    name = F.get(F.array(F.lit("Don_QUIJOTE-celestina"), F.lit("lazarillo"), F.lit("el-burlador"), F.lit("La Celestina"), F.lit("nada"), F.concat(F.lit("otra obra.v"), n)), (F.col("doc_id") % 6).cast("int"))
    rows = _documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("/a.b/c/"), name, F.lit(".txt")).alias("original_path"), F.when(F.col("doc_id") % 6 == 4, "Propio").alias("title"))
    return classify.literary(rows).select(F.col("document_id").cast("long").alias("doc_id"), "title", "author", "document_type", quality.profile_of(F.col("document_type")).alias("profile"))


@query(FORMS_SQL + f""", f AS (SELECT *, CASE WHEN source = (SELECT min(source) FROM documents) THEN 500 ELSE 1000 END AS lc, CASE WHEN source = (SELECT min(source) FROM documents) THEN 100 ELSE 200 END AS lw, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS kept FROM k)
SELECT doc_id, array_to_string(list_filter([CASE WHEN {strip_sql('canonical')} = '' THEN 'empty' END, CASE WHEN length(canonical) < lc THEN 'few characters' END, CASE WHEN len(regexp_extract_all(canonical, '{RWORD}')) < lw THEN 'few words' END], lambda e: e IS NOT NULL), '; ') AS errors FROM f WHERE kept""")
def thresholds_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest in which one source has other least lengths."""
    documents = spread(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    first = _documents(spark, sf_dir).agg(F.min("source")).first()[0]
    return corpus.ingested(documents, limits={first: (500, 100)}).select("doc_id", "errors")


@query("SELECT acquisition_status, count(*)::BIGINT AS n FROM remote_record WHERE acquisition_status IN ('DOWNLOADED', 'EXTRACTED') AND coalesce(local_path, '') <> '' GROUP BY acquisition_status")
def downloaded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.downloaded(table(spark, sf_dir, "remote_record"), ("DOWNLOADED", "EXTRACTED")).groupBy("acquisition_status").agg(F.count(F.lit(1)).alias("n"))


UUID_SQL = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', position(substr(h, 17, 1) in '0123456789abcdef'), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(f"""WITH m AS (SELECT d.document_id, any_value(regexp_extract(original_path, '[^/]*$')) AS f, any_value(x.doc_id) AS doc_id FROM document d JOIN documents x USING (document_id) WHERE original_path IS NOT NULL GROUP BY d.document_id),
mm AS (SELECT f AS raw_filename, CASE WHEN doc_id % 10 <> 0 THEN document_id END AS document_id, CASE WHEN doc_id % 7 = 0 THEN 'EXTRACTION_ERROR' ELSE 'MATCHED' END AS status, CASE WHEN doc_id % 14 = 0 THEN 'roto' END AS error, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('corpus:' || f)) AS h FROM m),
n AS (SELECT *, coalesce(document_id, {UUID_SQL}) AS id FROM mm), r AS (SELECT * FROM (SELECT regexp_extract(local_path, '[^/]*$') AS raw_filename, title, authors, row_number() OVER (PARTITION BY regexp_extract(local_path, '[^/]*$') ORDER BY oai_datestamp DESC NULLS LAST, identifier DESC, title DESC NULLS LAST, authors DESC NULLS LAST) AS rn FROM remote_record WHERE local_path IS NOT NULL) WHERE rn = 1),
j AS (SELECT n.*, r.title, r.authors, CASE WHEN n.status <> 'EXTRACTION_ERROR' THEN x.text END AS text FROM n LEFT JOIN r USING (raw_filename) LEFT JOIN documents x ON x.document_id = n.id)
SELECT id AS document_id, coalesce(nullif(title, ''), regexp_replace(raw_filename, '(.)\\.[^.]*$', '\\1')) AS title, nullif(array_to_string(authors, '; '), '') AS author, CASE WHEN text IS NULL THEN 'REJECTED' ELSE 'CANONICAL' END AS status,
 CASE WHEN status = 'EXTRACTION_ERROR' THEN coalesce(error, 'extraction failed') WHEN text IS NULL THEN 'no canonical text' END AS rejection_reason, len(regexp_extract_all(text, '{RWORD}'))::BIGINT AS word_count, sha256(text) AS canonical_sha256 FROM j""")
def rebuilt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a lost table, from the mapping of their files, harvested records and stored texts."""
    texts = _documents(spark, sf_dir).select("document_id", "doc_id", "text")
    paths = table(spark, sf_dir, "document").where("original_path is not null").select("document_id", F.element_at(F.split("original_path", "/"), -1).alias("raw_filename")).groupBy("document_id").agg(F.min("raw_filename").alias("raw_filename"))
    d = F.col("doc_id")
    mapping = paths.join(texts.select("document_id", "doc_id"), "document_id").select(
        "raw_filename", F.when(d % 10 != 0, F.col("document_id")).alias("document_id"), F.when(d % 7 == 0, "EXTRACTION_ERROR").otherwise("MATCHED").alias("status"), F.when(d % 14 == 0, "roto").alias("error"),
    )
    out = classify.rebuilt(mapping, table(spark, sf_dir, "remote_record"), texts, "corpus:", ["oai_datestamp", "identifier"])
    return out.select("document_id", "title", "author", "status", "rejection_reason", "word_count", "canonical_sha256")


@query(f"""WITH k AS (SELECT doc_id, {canonical_sql('text')} AS c FROM documents) SELECT doc_id, sha256(c) AS canonical_sha256, len(regexp_extract_all(c, '{RWORD}'))::BIGINT AS word_count, length(c)::BIGINT AS character_count, len(list_filter(regexp_split_to_array(c, '\\n[{RWS}]*\\n'), lambda p: {strip_sql('p')} <> ''))::BIGINT AS paragraph_count FROM k""")
def reprocessed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.reprocessed(spread(_documents(spark, sf_dir).select("doc_id", "text"))).select("doc_id", "canonical_sha256", "word_count", "character_count", "paragraph_count")


@query("""SELECT doc_id, 'part' || (doc_id % 50) AS filename, CASE WHEN doc_id % 50 % 3 <> 0 THEN 'm' || (doc_id % 50) END AS md5, CASE WHEN doc_id % 50 % 4 <> 0 THEN 's' || (doc_id % 50) END AS sha1 FROM documents""")
def segment_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir).select("doc_id", F.concat(F.lit("part"), (F.col("doc_id") % 50).cast("string")).alias("filename"))
    numbers = spark.range(50)
    name = F.concat(F.lit("part"), F.col("id").cast("string")).alias("filename")
    md5 = numbers.where("id % 3 != 0").select(name, F.concat(F.lit("m"), F.col("id").cast("string")).alias("sum"))
    sha1 = numbers.where("id % 4 != 0").select(name, F.concat(F.lit("s"), F.col("id").cast("string")).alias("sum"))
    return recovery.with_checksums(d, md5, sha1).select("doc_id", "filename", "md5", "sha1")


# intervals and lists that vary by document


@query("""SELECT doc_id::VARCHAR AS dump, s AS start_page, e AS end_page, g AS gap_before FROM documents, LATERAL (SELECT unnest(CASE WHEN doc_id % 2 = 0 THEN [{'s': 1::BIGINT, 'e': 10 + doc_id % 5, 'g': 0::BIGINT}, {'s': 11 + doc_id % 5, 'e': 30::BIGINT, 'g': 0}]
 ELSE [{'s': 1::BIGINT, 'e': 12 + doc_id % 3, 'g': 0::BIGINT}, {'s': 15 + doc_id % 3, 'e': 40::BIGINT, 'g': 2}] END, recursive := true))""")
def segment_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of overlapping page ranges the longest from each place on; a gap is told."""
    d = F.col("doc_id")
    s = lambda a, b: F.struct(a.cast("long").alias("start_page"), b.cast("long").alias("end_page"))
    one = F.lit(1)
    even = F.array(s(one, 10 + d % 5), s(one, F.lit(9)), s(F.lit(5), F.lit(9)), s(11 + d % 5, F.lit(30)), s(11 + d % 5, F.lit(20)), s(F.lit(22), F.lit(29)))
    odd = F.array(s(one, 12 + d % 3), s(F.lit(3), F.lit(8)), s(15 + d % 3, F.lit(40)))
    rows = _documents(spark, sf_dir).select(d.cast("string").alias("dump"), F.inline(F.when(d % 2 == 0, even).otherwise(odd)))
    return recovery.selected_segments(rows)


@query("""WITH y AS (SELECT doc_id, unnest([(2000 + doc_id % 20)::VARCHAR, '1999']) AS year FROM documents) SELECT doc_id, year, 'v' || (doc_id % 7) AS volume, unnest(CASE WHEN doc_id % 3 = 0 THEN [doc_id::VARCHAR] ELSE [doc_id::VARCHAR, 'b'] END) AS issue_id FROM y WHERE year <> '1999'
UNION ALL SELECT doc_id, '1999', 'w', 'c' FROM documents""")
def issue_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of journals from strings of years and groups of five fields."""
    n = F.col("doc_id").cast("string")
    first = F.concat((2000 + F.col("doc_id") % 20).cast("string"), F.lit("-v"), (F.col("doc_id") % 7).cast("string"), F.lit("-1-N- "), n, F.lit("-1"))
    second = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("-v"), (F.col("doc_id") % 7).cast("string"), F.lit("-2-N--2"))).otherwise(F.concat(F.lit("-v"), (F.col("doc_id") % 7).cast("string"), F.lit("-2-N-b-2")))
    rows = _documents(spark, sf_dir).select("doc_id", F.concat(first, second, F.lit(">>>2019-9-1>>>1999-w-1-S-c-1-left")).alias("list"))
    return metadata.issues(rows, "doc_id", "list").select("doc_id", "year", "volume", "issue_id")


@query("""SELECT doc_id, '2020' AS year, ' 1 ' AS volume, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'i' || doc_id END AS issue_id FROM documents""")
def issue_strings_untrimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant that keeps blanks and issues without an id."""
    value = F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.concat(F.lit("i"), F.col("doc_id").cast("string")))
    rows = _documents(spark, sf_dir).select("doc_id", F.concat(F.lit("2020- 1 -2-N-"), value, F.lit("-1")).alias("list"))
    return metadata.issues(rows, "doc_id", "list", trimmed=False).select("doc_id", "year", "volume", "issue_id")


# sinks, read back


@query("WITH " + FREQ_SQL + ranked_sql("r", "freq") + " SELECT source, ranking::VARCHAR AS \"Ranking\", word AS \"Palabra\", frequency::VARCHAR AS \"Frecuencia\", printf('%.10f', frequency::DOUBLE / total) AS \"FrecuenciaRelativa\", document_frequency::VARCHAR AS \"FrecuenciaDocumental\" FROM r WHERE source = (SELECT min(source) FROM documents)")
def frequency_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequency table of the first source as CSV files, read back."""
    first = _documents(spark, sf_dir).agg(F.min("source")).first()[0]
    ranked = lexicon.ranked(lexicon.frequencies(_documents(spark, sf_dir).where(F.col("source") == first)))
    at = scratch(spark)
    sinks.write_csv(sinks.frequency_rows(ranked), at, "Ranking")
    return files.csv_table(spark, at, ["Ranking", "Palabra", "Frecuencia", "FrecuenciaRelativa", "FrecuenciaDocumental"]).withColumn("source", F.lit(first))


@query("WITH " + FREQ_SQL + ranked_sql("r", "freq") + " SELECT source, ranking::VARCHAR AS \"Ranking\", (536 + ranking - 1)::VARCHAR AS \"Token\", word AS \"Palabra\", printf('%.6f', frequency::DOUBLE / total * 100) AS \"Porcentaje\", cumulative_frequency::VARCHAR AS \"FrecuenciaAcumulada\" FROM r WHERE source = (SELECT min(source) FROM documents) AND ranking <= 500")
def version_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary version of the first source, written in both orders from one computation; the alphabetical table read back."""
    first = _documents(spark, sf_dir).agg(F.min("source")).first()[0]
    vocabulary = lexicon.top(lexicon.frequencies(_documents(spark, sf_dir).where(F.col("source") == first)), 500)
    at = scratch(spark)
    sinks.write_both_orders(vocabulary, at)
    again = files.csv_table(spark, f"{at}/alphabetical", ["ranking", "token", "word", "relative_frequency", "cumulative_frequency"])
    return again.select(
        F.lit(first).alias("source"), F.col("ranking").alias("Ranking"), F.col("token").alias("Token"), F.col("word").alias("Palabra"), F.format_string("%.6f", F.col("relative_frequency").cast("double") * 100).alias("Porcentaje"),
        F.col("cumulative_frequency").alias("FrecuenciaAcumulada"),
    )


@query("SELECT source, count(*)::BIGINT AS documents, sum(length(text))::BIGINT AS characters FROM documents GROUP BY source")
def staged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a stage, in one directory for each source, written twice and read back."""
    at = scratch(spark)
    for _ in range(2):
        sinks.write_stage(_documents(spark, sf_dir).withColumnRenamed("source", "source_code"), at, "extracted")
    again = spark.read.parquet(f"{at}/extracted")
    return again.groupBy(F.col("source_code").alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("characters"))


@query("SELECT audit_id, document_id, editorial_score, approved, len(anomaly_report.anomalies)::INT AS anomalies FROM editorial_audit UNION ALL SELECT audit_id, document_id, editorial_score, approved, len(anomaly_report.anomalies)::INT FROM editorial_audit WHERE approved")
def audit_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits appended in two runs, then a JSON report for each, read back from its directory."""
    audits, at = table(spark, sf_dir, "editorial_audit"), scratch(spark)
    sinks.append_audits(audits, f"{at}/audits")
    sinks.append_audits(audits.where("approved"), f"{at}/audits")
    stored = spark.read.parquet(f"{at}/audits")
    sinks.write_reports(stored, f"{at}/reports", "audit_id")
    again = files.json_lines(spark, f"{at}/reports", "audit_id long, document_id string, editorial_score int, approved boolean, anomaly_report struct<anomalies:array<struct<code:string>>>")
    return again.select("audit_id", "document_id", "editorial_score", "approved", F.size("anomaly_report.anomalies").alias("anomalies")).withColumn("anomalies", F.when(F.col("anomalies") >= 0, F.col("anomalies")))


@query("SELECT source_code, source_name || CASE WHEN enabled THEN ' *' ELSE '' END AS source_name, enabled FROM source UNION ALL SELECT 'nueva', 'Nueva', true")
def source_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources written, then new states of some and one more source merged in; the checked new version read back."""
    at = scratch(spark)
    sources = table(spark, sf_dir, "source").select("source_code", "source_name", "enabled")
    current = sinks.replace_checked(sources, at, rows=sources.count(), keys=("source_code",))
    incoming = sources.where("enabled").withColumn("source_name", F.concat("source_name", F.lit(" *"))).union(spark.createDataFrame([("nueva", "Nueva", True)], sources.schema))
    return spark.read.parquet(sinks.upsert(spark, current, incoming, "source_code"))


def _entries_sql(version: str) -> str:
    return f"e AS (SELECT source, length(text)::BIGINT AS characters, len(regexp_extract_all(text, '{RWORD}'))::BIGINT AS words, sha256(concat_ws(chr(1), source, '{version}', doc_id, sha256(text))) AS h FROM documents)"


PARTS_SQL = " || '-' || ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT)::VARCHAR" for i in range(8))


@query(f"WITH {_entries_sql('1.0')} SELECT source, '1.0' AS version, count(*)::BIGINT AS documents, sum(words)::BIGINT AS words, sum(characters)::BIGINT AS characters, sha256({PARTS_SQL}) AS entries_sha256 FROM e GROUP BY source")
def corpus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.manifest(corpus.manifest_entries(_documents(spark, sf_dir), "1.0"))


@query(f"WITH {_entries_sql('1.1')} SELECT source, '1.1' AS version, count(*)::BIGINT AS documents, sum(words)::BIGINT AS words, sum(characters)::BIGINT AS characters, sha256({PARTS_SQL}) AS entries_sha256 FROM e GROUP BY source")
def consolidated_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version of the corpus written, its first source replaced, and the manifest as it then stands."""
    at = scratch(spark)
    documents = _documents(spark, sf_dir)
    first = documents.agg(F.min("source")).first()[0]
    corpus.consolidate(documents.where(F.col("source") != first).unionByName(documents.where(F.col("source") == first).limit(1)), at, "1.1")
    return corpus.consolidate(documents.where(F.col("source") == first), at, "1.1")


@query(f"WITH d AS (SELECT source, text FROM documents) SELECT source, sum(length(replace(text, chr(13), chr(10))))::BIGINT AS characters, count(*)::BIGINT AS texts FROM d GROUP BY source".replace("replace(text, chr(13), chr(10))", "replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))"))
def scanned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written as lines of files, one directory for each source, found again by the directory scan, decoded and counted."""
    at = scratch(spark)
    marked = _documents(spark, sf_dir).select("source", F.concat("text", F.lit("\u0001")).alias("value"))
    marked.write.partitionBy("source").text(at)
    found = files.read_files(spark, at, "TXT").select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), F.split("text", "\u0001\n").alias("parts"))
    texts = found.select("source", F.explode(F.filter("parts", lambda p: p != "")).alias("text"))
    return texts.groupBy("source").agg(F.sum(F.length("text")).alias("characters"), F.count(F.lit(1)).alias("texts"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

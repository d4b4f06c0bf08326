"""The queries of the operators, each (spark, sf_dir) -> DataFrame, with SQL that gives the same on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus, lexicon, metadata, quality, recovery
from ..session import spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# RE2 forms of the character classes of functions.text.
RWS = T.code_points(T.SPACES, braces=True)
RWS_NO_LF = T.code_points(T.SPACES, (0xA,), braces=True)
RSL = "\\r\\n|[" + T.code_points(T.LINE_ENDS, braces=True) + "]"
RWORD = "[\\p{L}\\p{Nl}\\p{No}]+(?:[''’\\-][\\p{L}\\p{Nl}\\p{No}]+)*"
RSYMBOL = "[^\\p{L}\\p{N}_" + RWS + ".,;:¿?¡!()«»“”\"''’—–\\-]"

WORDS_SQL = """words AS (SELECT doc_id, source, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+'), lambda x: regexp_full_match(x, '[a-záéíóúüñıſ]{2,}'))) AS word FROM documents)"""
FREQ_SQL = WORDS_SQL + """, freq AS (SELECT source, word, sum(n)::BIGINT AS frequency, count(*)::BIGINT AS document_frequency
 FROM (SELECT doc_id, source, word, count(*) AS n FROM words GROUP BY ALL) GROUP BY ALL)"""
MERGED_SQL = FREQ_SQL + ", merged AS (SELECT word, sum(frequency)::BIGINT AS frequency, sum(document_frequency)::BIGINT AS document_frequency FROM freq GROUP BY word)"
ALL_SQL = MERGED_SQL + ", every AS (SELECT source, word, frequency, document_frequency FROM freq UNION ALL SELECT 'completo', word, frequency, document_frequency FROM merged)"


def ranked_sql(name: str, of: str) -> str:
    return f""", {name} AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY frequency DESC, word)::BIGINT AS ranking, sum(frequency) OVER (PARTITION BY source)::BIGINT AS total,
 sum(frequency) OVER (PARTITION BY source ORDER BY frequency DESC, word ROWS UNBOUNDED PRECEDING)::BIGINT AS cumulative_frequency FROM {of})"""


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^[{RWS}]+|[{RWS}]+$', '', 'g')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.frequencies(_documents(spark, sf_dir))


# vocabulary


@query("WITH " + MERGED_SQL + ", m AS (SELECT 'completo' AS source, * FROM merged)" + ranked_sql("r", "m") + """
SELECT ranking, 536 + ranking - 1 AS token, word, frequency, document_frequency, frequency::DOUBLE / total AS relative_frequency, cumulative_frequency, cumulative_frequency * 100.0::DOUBLE / total AS coverage FROM r WHERE ranking <= 20000""")
def lexicon_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = lexicon.merged(_frequencies(spark, sf_dir)).withColumn("source", F.lit(lexicon.ALL))
    return lexicon.top(every, 20_000).select("ranking", "token", "word", "frequency", "document_frequency", "relative_frequency", "cumulative_frequency", "coverage")


@query("WITH " + FREQ_SQL + ranked_sql("r", "freq") + " SELECT source, ranking, word, frequency, document_frequency FROM r")
def lexicon_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.ranked(_frequencies(spark, sf_dir)).select("source", "ranking", "word", "frequency", "document_frequency")


@query("WITH " + ALL_SQL + " SELECT source, count(*)::BIGINT AS vocabulary, sum(frequency)::BIGINT AS tokens, count(*) FILTER (frequency = 1)::BIGINT AS hapax FROM every GROUP BY source")
def lexicon_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.summary(_frequencies(spark, sf_dir))


SMALL_SIZES = (200, 500, 1000, 2000, 65_000)
SIZES_SQL = "sizes AS (SELECT unnest([200, 500, 1000, 2000, 65000])::BIGINT AS size)"


@query("WITH " + ALL_SQL + ranked_sql("r", "every") + ", " + SIZES_SQL + """
SELECT source, size, max(ranking) AS vocabulary, least(size, max(ranking)) AS selected, 536::BIGINT AS first_token, 536 + least(size, max(ranking)) - 1 AS last_token, max(total) AS total_occurrences,
 coalesce(sum(frequency) FILTER (ranking <= size), 0)::BIGINT AS covered, (max(total) - coalesce(sum(frequency) FILTER (ranking <= size), 0))::BIGINT AS outside,
 coalesce(sum(frequency) FILTER (ranking <= size), 0)::BIGINT * 100.0::DOUBLE / max(total) AS coverage FROM r CROSS JOIN sizes GROUP BY source, size""")
def lexicon_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.versions(_frequencies(spark, sf_dir), SMALL_SIZES)


@query("WITH " + ALL_SQL + ", n AS (SELECT source, count(*) AS vocabulary FROM every GROUP BY source), " + SIZES_SQL + """ SELECT source, size, least(size, vocabulary) <= vocabulary AS selects_all, 536 + least(size, vocabulary) - 1 <= 65535 AS tokens_in_range, true AS covered_in_total FROM n CROSS JOIN sizes""")
def version_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.version_checks(lexicon.versions(_frequencies(spark, sf_dir), SMALL_SIZES))


@query("WITH " + MERGED_SQL + ", m AS (SELECT 'completo' AS source, * FROM merged)" + ranked_sql("r", "m") + " SELECT ranking, word, frequency FROM r WHERE ranking <= 300")
def lexicon_top_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 300 first words of all sources; fewer would be an error."""
    every = lexicon.merged(_frequencies(spark, sf_dir)).withColumn("source", F.lit(lexicon.ALL))
    return lexicon.top_exact(every, 300).select("ranking", "word", "frequency")


@query("WITH " + FREQ_SQL + ranked_sql("r", "freq") + """ SELECT source, ranking AS cutoff, cumulative_frequency, cumulative_frequency * 100.0::DOUBLE / total AS coverage FROM r
 WHERE ranking IN (10, 50, 100, 128, 512, 1024, 5000, 10000, 25000, 50000, 65000)""")
def lexicon_cutoff_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.cutoff_coverage(_frequencies(spark, sf_dir))


@query("WITH " + FREQ_SQL + ranked_sql("r", "freq") + " SELECT source, word, 536 + ranking - 1 AS token, row_number() OVER (PARTITION BY source ORDER BY word)::BIGINT AS alphabetical FROM r WHERE ranking <= 1000")
def lexicon_alphabetical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.alphabetical(lexicon.top(_frequencies(spark, sf_dir), 1000)).select("source", "word", "token", "alphabetical")


@query("WITH " + ALL_SQL + ", m AS (SELECT 'completo' AS source, * FROM merged)" + ranked_sql("v", "m") + ", " + SIZES_SQL + """, j AS (SELECT e.source, e.frequency, v.ranking FROM every e LEFT JOIN v USING (word))
SELECT source, size, count(*)::BIGINT AS source_vocabulary, sum(frequency)::BIGINT AS total_occurrences, coalesce(sum(frequency) FILTER (ranking <= size), 0)::BIGINT AS covered,
 (sum(frequency) - coalesce(sum(frequency) FILTER (ranking <= size), 0))::BIGINT AS outside, count(*) FILTER (ranking <= size)::BIGINT AS shared_words,
 coalesce(sum(frequency) FILTER (ranking <= size), 0)::BIGINT * 100.0::DOUBLE / sum(frequency)::BIGINT AS coverage, (SELECT count(*) FROM merged) >= size AS complete FROM j CROSS JOIN sizes GROUP BY source, size""")
def lexicon_cross_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.cross_coverage(_frequencies(spark, sf_dir), SMALL_SIZES)


def _sources(spark: SparkSession, sf_dir: str, n: int) -> list[str]:
    """The first sources by code: a fixed table."""
    return [r[0] for r in table(spark, sf_dir, "source").orderBy("source_code").limit(n).collect()]


def _comparison_sql() -> str:
    first = ", s AS (SELECT source_code, row_number() OVER (ORDER BY source_code) - 1 AS i FROM source), p AS (SELECT r.word, s.i, r.frequency, r.ranking FROM r JOIN s ON r.source = s.source_code WHERE s.i < 40)"
    columns = ", ".join(f"coalesce(max(p.frequency) FILTER (p.i = {i}), 0)::BIGINT AS frequency_{i}" for i in range(40)) + ", " + ", ".join(f"coalesce(max(p.ranking) FILTER (p.i = {i}), 0)::BIGINT AS ranking_{i}" for i in range(40))
    return f"{first} SELECT v.ranking, v.word, v.frequency, {columns} FROM v LEFT JOIN p USING (word) WHERE v.ranking <= 5000 GROUP BY v.ranking, v.word, v.frequency"


@query("WITH " + MERGED_SQL + ", m AS (SELECT 'completo' AS source, * FROM merged)" + ranked_sql("v", "m") + ranked_sql("r", "freq") + _comparison_sql())
def lexicon_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.comparison(_frequencies(spark, sf_dir), _sources(spark, sf_dir, 40), 5000)


def _set_sql(operator: str) -> str:
    of = "SELECT word FROM freq WHERE source = (SELECT source_code FROM source ORDER BY source_code LIMIT 1 OFFSET {})"
    return f"WITH {FREQ_SQL} {of.format(0)} {operator} {of.format(1)}"


@query(_set_sql("INTERSECT"))
def vocabulary_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.shared_words(_frequencies(spark, sf_dir), *_sources(spark, sf_dir, 2))


@query(_set_sql("EXCEPT"))
def vocabulary_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.missing_words(_frequencies(spark, sf_dir), *_sources(spark, sf_dir, 2))


@query(_set_sql("UNION"))
def vocabulary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.all_words(_frequencies(spark, sf_dir), *_sources(spark, sf_dir, 2))


@query("WITH " + FREQ_SQL + ranked_sql("r", "freq") + """ SELECT source, count(*)::BIGINT AS words, min(ranking) AS first_rank, max(ranking) AS last_rank, (count(*) - count(DISTINCT ranking))::BIGINT AS repeated_ranks,
 (max(ranking) - min(ranking) + 1 - count(DISTINCT ranking))::BIGINT AS missing_ranks, count(*) FILTER (token <> 536 + place - 1)::BIGINT AS wrong_tokens, count(*) FILTER (token NOT BETWEEN 536 AND 65535)::BIGINT AS tokens_out_of_range FROM (SELECT *, 536 + ranking - 1 AS token, row_number() OVER (PARTITION BY source ORDER BY frequency DESC, word) AS place FROM r) WHERE ranking <= 5000 GROUP BY source""")
def sequence_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.integrity(lexicon.top(_frequencies(spark, sf_dir), 5000))


@query("""SELECT batch_no, epoch_us(exported_at) AS exported_us, ranking, frequency, before FROM (SELECT batch_no, exported_at, ranking, absolute_frequency AS frequency,
 lag(absolute_frequency) OVER (PARTITION BY batch_no, exported_at ORDER BY ranking, word, absolute_frequency NULLS FIRST) AS before FROM (SELECT DISTINCT batch_no, exported_at, ranking, word, absolute_frequency FROM lexical_frequency)) WHERE frequency > before""")
def published_rank_rises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows whose frequency is greater than that of the rank before."""
    from pyspark.sql.window import Window

    rows = table(spark, sf_dir, "lexical_frequency").select("batch_no", "exported_at", "ranking", "word", F.col("absolute_frequency").alias("frequency")).distinct()
    before = F.lag("frequency").over(Window.partitionBy("batch_no", "exported_at").orderBy("ranking", "word", "frequency"))
    return rows.withColumn("before", before).where("frequency > before").select("batch_no", F.unix_micros("exported_at").alias("exported_us"), "ranking", "frequency", "before")


@query("WITH " + MERGED_SQL + """, v AS (SELECT word FROM token_vocabulary), a AS (SELECT source, f.word, frequency, v.word IS NOT NULL AS known FROM freq f LEFT JOIN v USING (word))
SELECT source, count(*)::BIGINT AS source_vocabulary, count(*) FILTER (known)::BIGINT AS shared_words, sum(frequency)::BIGINT AS tokens, coalesce(sum(frequency) FILTER (known), 0)::BIGINT AS covered,
 coalesce(sum(frequency) FILTER (known), 0)::BIGINT * 100.0::DOUBLE / sum(frequency)::BIGINT AS token_coverage, count(*) FILTER (known) * 100.0::DOUBLE / count(*) AS word_coverage FROM a GROUP BY source""")
def vocabulary_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the existing tokenizer's vocabulary, a fixed table, covers of each source."""
    known = table(spark, sf_dir, "token_vocabulary").select("word", F.lit(True).alias("known")).distinct()
    rows = _frequencies(spark, sf_dir).join(known, "word", "left")
    covered = F.coalesce(F.sum(F.when(F.col("known"), F.col("frequency"))), F.lit(0))
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("source_vocabulary"), F.count("known").alias("shared_words"), F.sum("frequency").alias("tokens"), covered.alias("covered"),
        (covered * 100.0 / F.sum("frequency")).alias("token_coverage"), (F.count("known") * 100.0 / F.count(F.lit(1))).alias("word_coverage"),
    )


# texts


@query(f"""SELECT doc_id, length(text)::BIGINT AS character_count, len(regexp_extract_all(text, '{RWORD}'))::BIGINT AS word_count,
 len(list_filter(regexp_split_to_array(text, '\\n[{RWS}]*\\n'), lambda p: {strip_sql('p')} <> ''))::BIGINT AS paragraph_count FROM documents""")
def text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(_documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", F.length("text").cast("long").alias("character_count"), T.word_count(F.col("text")).alias("word_count"), T.paragraph_count(F.col("text")).alias("paragraph_count"))


def clean_sql(c: str) -> str:
    c = f"regexp_replace({c}, '\\r\\n?', '\\n', 'g')"
    c = f"regexp_replace(regexp_replace({c}, '(?i)\\[\\[PÁGINA[{RWS}]+\\p{{Nd}}+\\]\\]', '\\n', 'g'), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')"
    c = f"regexp_replace({c}, '[ \\t]+', ' ', 'g')"
    c = f"array_to_string(list_transform(regexp_split_to_array({c}, '{RSL}'), lambda l: {strip_sql('l')}), '\\n')"
    return strip_sql(f"regexp_replace({c}, '\\n{{3,}}', '\\n\\n', 'g')").replace("'\\n\\n'", "chr(10) || chr(10)").replace("'\\n'", "chr(10)")


def normalize_sql(c: str) -> str:
    c = f"regexp_replace(nfc_normalize({c}), '[\\x{{00a0}}\\x{{2007}}\\x{{202f}}]', ' ', 'g')"
    c = f"regexp_replace({c}, '[ \\t]+\\n', chr(10), 'g')"
    c = f"regexp_replace({c}, '[{RWS_NO_LF}]+', ' ', 'g')"
    return strip_sql(f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')") + " || chr(10)"


def canonical_sql(c: str) -> str:
    c = f"regexp_replace({c}, '([A-Za-zÁÉÍÓÚÜÑáéíóúüñ]+)-\\n([a-záéíóúüñ]+)', '\\1\\2', 'g')"
    c = f"regexp_replace({c}, '(?m)^[{RWS}]*\\p{{Nd}}+[{RWS}]*$', '', 'g')"
    return strip_sql(f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')") + " || chr(10)"


FORMS_SQL = f"WITH c AS (SELECT doc_id, source, text, {clean_sql('text')} AS cleaned FROM documents), n AS (SELECT *, {normalize_sql('cleaned')} AS normalized FROM c), k AS (SELECT *, {canonical_sql('normalized')} AS canonical FROM n)"


@query(f"SELECT doc_id, sha256({clean_sql('text')}) AS sha256 FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.sha2(T.clean(F.col("text")), 256).alias("sha256"))


@query(FORMS_SQL + " SELECT doc_id, sha256(normalized) AS sha256 FROM k")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.sha2(T.normalize(T.clean(F.col("text"))), 256).alias("sha256"))


@query(FORMS_SQL + " SELECT doc_id, sha256(canonical) AS sha256 FROM k")
def canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.sha2(T.canonical(T.normalize(T.clean(F.col("text")))), 256).alias("sha256"))


@query("SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, sha1(text) AS sha1 FROM documents")
def text_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5(F.encode("text", "UTF-8")).alias("md5"), F.sha1(F.encode("text", "UTF-8")).alias("sha1"))


@query("""SELECT document_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', position(substr(h, 17, 1) in '0123456789abcdef'), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
 FROM (SELECT document_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(original_path)) AS h FROM (SELECT DISTINCT document_id, original_path FROM document WHERE original_path IS NOT NULL))""")
def path_uuids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "document").where("original_path is not null").select("document_id", "original_path").distinct()
    return rows.select("document_id", T.uuid5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.col("original_path")).alias("uuid"))


@query(f"SELECT doc_id, sha256(substr({strip_sql(f'''regexp_replace(lower(text), '[{RWS}]+', ' ', 'g')''')}, 1, 5000)) AS likeness, CASE WHEN length(s) > 500 THEN substr(s, 1, 500) || '...' ELSE s END AS sample FROM (SELECT doc_id, text, {strip_sql(f'''regexp_replace(text, '[{RWS}]+', ' ', 'g')''')} AS s FROM documents)")
def text_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", F.sha2(T.similarity_key(F.col("text")), 256).alias("likeness"), T.shortened(F.col("text"), 500).alias("sample"))


@query(f"SELECT doc_id, CASE WHEN {strip_sql('text')} = '' THEN 'empty' ELSE '' END AS x, array_to_string(list_filter([CASE WHEN length(text) < 1000 THEN 'few characters' END, CASE WHEN len(regexp_extract_all(text, '{RWORD}')) < 200 THEN 'few words' END], lambda e: e IS NOT NULL), '; ') AS errors, CASE WHEN contains(text, chr(65533)) THEN 'replacement characters' ELSE '' END AS warnings FROM documents".replace(f"CASE WHEN {strip_sql('text')} = '' THEN 'empty' ELSE '' END AS x, ", ""))
def validate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.validated(spread(_documents(spark, sf_dir).select("doc_id", "text"))).select("doc_id", "errors", "warnings")


@query("SELECT doc_id, sha256(text) AS sha256, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS kept FROM documents")
def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.exact_duplicates(_documents(spark, sf_dir))


@query("SELECT DISTINCT identifier, local_path FROM remote_record r WHERE local_path IS NOT NULL AND NOT EXISTS (SELECT 1 FROM document d WHERE d.original_path = r.local_path AND d.status = 'CANONICAL' AND d.title IS NOT NULL)")
def new_records_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "remote_record").where("local_path is not null").select("identifier", "local_path").distinct()
    return corpus.new_only(records, table(spark, sf_dir, "document").where("status = 'CANONICAL' and title is not null").select(F.col("original_path").alias("local_path")), "local_path")


@query("SELECT doc_id, document_id FROM documents x WHERE NOT EXISTS (SELECT 1 FROM editorial_audit a WHERE a.document_id = x.document_id AND a.approved AND a.editorial_score >= 90) ORDER BY doc_id LIMIT 100")
def first_unaudited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 first documents that no audit has approved with 90 or more: the cap of a run, after what is known is left out."""
    audits = table(spark, sf_dir, "editorial_audit").where("approved and editorial_score >= 90")
    return corpus.first_new(_documents(spark, sf_dir).select("doc_id", "document_id"), audits, "document_id", "doc_id", 100)


@query(FORMS_SQL + f""", f AS (SELECT *, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS kept FROM k)
SELECT doc_id, source, sha256(text) AS sha256, sha256(canonical) AS canonical_sha256, length(canonical)::BIGINT AS characters, len(regexp_extract_all(canonical, '{RWORD}'))::BIGINT AS words,
 len(list_filter(regexp_split_to_array(canonical, '\\n[{RWS}]*\\n'), lambda p: {strip_sql('p')} <> ''))::BIGINT AS paragraphs,
 array_to_string(list_filter([CASE WHEN {strip_sql('canonical')} = '' THEN 'empty' END, CASE WHEN length(canonical) < 1000 THEN 'few characters' END, CASE WHEN len(regexp_extract_all(canonical, '{RWORD}')) < 200 THEN 'few words' END], lambda e: e IS NOT NULL), '; ') AS errors FROM f WHERE kept""")
def ingest_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.ingested(spread(_documents(spark, sf_dir).select("doc_id", "source", "text")))


# quality

MEASURES_SQL = f"""m0 AS (SELECT d.doc_id, d.document_id, d.text, list_transform(CASE WHEN s[-1] = '' THEN s[:-2] ELSE s END, lambda l: {strip_sql('l')}) AS ls FROM documents d, LATERAL (SELECT regexp_split_to_array(d.text, '{RSL}') AS s)),
m1 AS (SELECT *, list_filter(ls, lambda l: l <> '') AS fl FROM m0),
rl AS (SELECT doc_id, line, count(*)::BIGINT AS n, min(i) AS first FROM (SELECT doc_id, regexp_replace(l, '[{RWS}]+', ' ', 'g') AS line, i FROM (SELECT doc_id, unnest(fl) AS l, unnest(range(1, len(fl) + 1)) AS i FROM m1) WHERE length(l) >= 5) GROUP BY ALL HAVING count(*) >= 3),
rep AS (SELECT doc_id, sum(n)::BIGINT AS r FROM rl GROUP BY doc_id),
m AS (SELECT m1.doc_id, document_id, length(text)::BIGINT AS character_count, len(regexp_extract_all(text, '{RWORD}'))::BIGINT AS word_count, len(ls)::BIGINT AS line_count, len(fl)::BIGINT AS non_empty_line_count,
 len(regexp_extract_all(text, '\\x{{fffd}}'))::BIGINT AS replacement_character_count, 0::BIGINT AS null_character_count, len(regexp_extract_all(text, '[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]'))::BIGINT AS control_character_count,
 len(regexp_extract_all(text, '(?i)\\[\\[PÁGINA[{RWS}]+\\p{{Nd}}+\\]\\]'))::BIGINT AS page_marker_count, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]-\\n'))::BIGINT AS hyphenated_line_break_count,
 coalesce(len(regexp_extract_all(text, '{RSYMBOL}'))::DOUBLE / nullif(length(text), 0), 0) AS symbol_ratio,
 coalesce(len(list_filter(fl, lambda l: regexp_full_match(regexp_replace(l, '[{RWS}.,:;()\\-–—]', '', 'g'), '[\\p{{Nd}}\\x{{b2}}\\x{{b3}}\\x{{b9}}\\x{{2070}}-\\x{{2079}}\\x{{2080}}-\\x{{2089}}]+')))::DOUBLE / nullif(len(fl), 0), 0) AS numeric_line_ratio,
 coalesce(coalesce(r, 0)::DOUBLE / nullif(len(fl), 0), 0) AS repeated_line_ratio,
 coalesce(len(list_filter(fl, lambda l: len(regexp_extract_all(l, '\\p{{L}}')) >= 5 AND len(regexp_extract_all(l, '\\p{{Lu}}')) >= 0.9 * len(regexp_extract_all(l, '\\p{{L}}'))))::DOUBLE / nullif(len(fl), 0), 0) AS uppercase_line_ratio,
 coalesce(len(list_filter(fl, lambda l: length(l) <= 25))::DOUBLE / nullif(len(fl), 0), 0) AS short_line_ratio, len(list_filter(fl, lambda l: length(l) > 400))::BIGINT AS long_line_count FROM m1 LEFT JOIN rep USING (doc_id))"""


@query("WITH " + MEASURES_SQL + " SELECT * EXCLUDE (document_id) FROM m")
def anomaly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measures(spread(_documents(spark, sf_dir).select("doc_id", "text"))).drop("text")


# The profiles as the settings state them, written out here and not taken from the operator.
PROFILES_SQL = """kinds(document_type, profile) AS (VALUES ('novela', 'novela'), ('novela_picaresca', 'novela'), ('cuento', 'novela'), ('relato', 'novela'), ('obra_dialogada', 'obra_dialogada'), ('teatro', 'obra_dialogada'),
 ('obra_teatral', 'obra_dialogada'), ('drama', 'obra_dialogada'), ('obra_dramatica', 'obra_dialogada'), ('poesia', 'poesia'), ('poemario', 'poesia'), ('verso', 'poesia'), ('articulo_cientifico', 'articulo_cientifico'),
 ('articulo_academico', 'articulo_cientifico'), ('paper', 'articulo_cientifico'), ('tesis', 'tesis'), ('tesina', 'tesis'), ('trabajo_recepcion', 'tesis'), ('noticia', 'prensa'), ('articulo_periodistico', 'prensa'),
 ('editorial_periodistico', 'prensa'), ('prensa', 'prensa'), ('ensayo', 'libro_no_ficcion'), ('libro_no_ficcion', 'libro_no_ficcion'), ('divulgacion', 'libro_no_ficcion'), ('manual', 'libro_no_ficcion')),
limits(profile, words, characters, numeric, repeated, upper, short, long) AS (VALUES ('default', 1000, 5000, 0.03::DOUBLE, 0.08::DOUBLE, 0.08::DOUBLE, 0.65::DOUBLE, 400), ('novela', 1000, 5000, 0.02, 0.06, 0.06, 0.55, 400),
 ('obra_dialogada', 1000, 5000, 0.06, 0.35, 0.30, 0.85, 400), ('poesia', 1000, 5000, 0.03, 0.20, 0.15, 0.90, 400), ('articulo_cientifico', 500, 5000, 0.12, 0.08, 0.10, 0.65, 600), ('tesis', 5000, 5000, 0.10, 0.12, 0.12, 0.65, 700),
 ('prensa', 100, 500, 0.08, 0.10, 0.15, 0.60, 400), ('libro_no_ficcion', 1000, 5000, 0.06, 0.08, 0.10, 0.65, 400)),
rules(place, code, severity, penalty, message) AS (VALUES (1, 'replacement_characters', 'ERROR', 40, 'Se encontraron caracteres Unicode de sustitución.'), (2, 'null_characters', 'ERROR', 50, 'Se encontraron caracteres nulos.'),
 (3, 'control_characters', 'ERROR', 40, 'Persisten caracteres de control.'), (4, 'page_markers', 'ERROR', 20, 'Persisten marcas temporales de página.'), (5, 'excessive_symbols', 'WARNING', 20, 'La proporción de símbolos no lingüísticos es elevada.'),
 (6, 'numeric_lines', 'WARNING', 10, 'Existe una proporción elevada de líneas numéricas.'), (7, 'repeated_lines', 'WARNING', 15, 'Se detectó repetición excesiva de líneas.'), (8, 'uppercase_lines', 'WARNING', 10, 'Existe una proporción elevada de líneas en mayúsculas.'),
 (9, 'hyphenated_line_breaks', 'WARNING', 5, 'Se detectaron posibles palabras cortadas por salto de línea.'), (10, 'excessive_short_lines', 'INFO', 5, 'El documento contiene muchas líneas cortas. Puede corresponder a teatro o verso.'),
 (11, 'excessive_long_lines', 'INFO', 5, 'Se encontraron líneas excesivamente largas.')),
changes(profile, code, severity, penalty) AS (VALUES ('obra_dialogada', 'numeric_lines', 'WARNING', 5), ('obra_dialogada', 'excessive_short_lines', 'INFO', 0), ('poesia', 'repeated_lines', NULL, 5), ('poesia', 'uppercase_lines', NULL, 5),
 ('articulo_cientifico', 'numeric_lines', 'INFO', 0), ('articulo_cientifico', 'excessive_long_lines', NULL, 2), ('tesis', 'numeric_lines', 'INFO', 0), ('tesis', 'repeated_lines', NULL, 5)),
off(profile, code) AS (VALUES ('obra_dialogada', 'repeated_lines'), ('obra_dialogada', 'uppercase_lines'), ('poesia', 'excessive_short_lines')),
st AS (SELECT document_id, max_by(document_type, updated_at) AS document_type FROM document GROUP BY document_id), p AS (SELECT m.doc_id, coalesce(kinds.profile, 'default') AS profile FROM m LEFT JOIN st USING (document_id) LEFT JOIN kinds USING (document_type))"""
NUMERIC_SQL = f"regexp_full_match(regexp_replace(l, '[{RWS}.,:;()\\-–—]', '', 'g'), '[\\p{{Nd}}\\x{{b2}}\\x{{b3}}\\x{{b9}}\\x{{2070}}-\\x{{2079}}\\x{{2080}}-\\x{{2089}}]+')"
UPPER_SQL = "len(regexp_extract_all(l, '\\p{L}')) >= 5 AND len(regexp_extract_all(l, '\\p{Lu}')) >= 0.9 * len(regexp_extract_all(l, '\\p{L}'))"
ANOMALIES_SQL = f"""{MEASURES_SQL}, {PROFILES_SQL},
w AS (SELECT m.*, fl, l.*, len(list_filter(fl, lambda x: length(x) > l.long))::BIGINT AS over_long FROM m JOIN m1 USING (doc_id) JOIN p USING (doc_id) JOIN limits l USING (profile)),
hits AS (SELECT doc_id, profile, unnest([{{'code': 'replacement_characters', 'hit': replacement_character_count > 0, 'n': replacement_character_count, 'ratio': NULL::DOUBLE, 'shown': []::VARCHAR[]}}, {{'code': 'null_characters', 'hit': null_character_count > 0, 'n': null_character_count, 'ratio': NULL, 'shown': []}},
 {{'code': 'control_characters', 'hit': control_character_count > 0, 'n': control_character_count, 'ratio': NULL, 'shown': []}}, {{'code': 'page_markers', 'hit': page_marker_count > 0, 'n': page_marker_count, 'ratio': NULL, 'shown': []}}, {{'code': 'excessive_symbols', 'hit': symbol_ratio > 0.03::DOUBLE, 'n': NULL, 'ratio': symbol_ratio, 'shown': []}},
 {{'code': 'numeric_lines', 'hit': numeric_line_ratio > numeric, 'n': len(list_filter(fl, lambda l: {NUMERIC_SQL})), 'ratio': numeric_line_ratio, 'shown': list_filter(fl, lambda l: {NUMERIC_SQL})[:10]}},
 {{'code': 'repeated_lines', 'hit': repeated_line_ratio > repeated, 'n': (SELECT coalesce(sum(n), 0)::BIGINT FROM rl WHERE rl.doc_id = w.doc_id), 'ratio': repeated_line_ratio, 'shown': (SELECT list(line || ' (' || n || ' veces)' ORDER BY n DESC, first)[:10] FROM rl WHERE rl.doc_id = w.doc_id)}},
 {{'code': 'uppercase_lines', 'hit': uppercase_line_ratio > upper, 'n': len(list_filter(fl, lambda l: {UPPER_SQL})), 'ratio': uppercase_line_ratio, 'shown': list_filter(fl, lambda l: {UPPER_SQL})[:10]}},
 {{'code': 'hyphenated_line_breaks', 'hit': hyphenated_line_break_count > 10, 'n': hyphenated_line_break_count, 'ratio': NULL, 'shown': []}},
 {{'code': 'excessive_short_lines', 'hit': short_line_ratio > short, 'n': len(list_filter(fl, lambda l: length(l) <= 25)), 'ratio': short_line_ratio, 'shown': list_filter(fl, lambda l: length(l) <= 25)[:10]}},
 {{'code': 'excessive_long_lines', 'hit': over_long > 0, 'n': over_long, 'ratio': NULL, 'shown': list_transform(list_filter(fl, lambda l: length(l) > w.long)[:5], lambda l: substr(l, 1, 200))}}], recursive := true) FROM w),
an AS (SELECT h.doc_id, h.profile, place, code, coalesce(c.severity, r.severity) AS severity, coalesce(c.penalty, r.penalty) AS penalty, message, n, ratio, shown FROM hits h JOIN rules r USING (code) LEFT JOIN changes c USING (profile, code) WHERE hit AND NOT EXISTS (SELECT 1 FROM off WHERE off.profile = h.profile AND off.code = h.code))"""


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with the newest type of their document."""
    state = table(spark, sf_dir, "document").groupBy("document_id").agg(F.max_by("document_type", "updated_at").alias("document_type"))
    return spread(_documents(spark, sf_dir).select("doc_id", "document_id", "text")).join(state, "document_id", "left")


@query(f"""WITH {ANOMALIES_SQL}, e AS (SELECT doc_id, sum(penalty) AS lost, string_agg(code, ' ' ORDER BY place) FILTER (severity = 'ERROR') AS errors, string_agg(code, ' ' ORDER BY place) FILTER (severity = 'WARNING') AS warnings FROM an GROUP BY doc_id)
SELECT w.doc_id, w.profile, greatest(0, least(100, 100 - coalesce(lost, 0)))::BIGINT AS score, array_to_string(list_filter([errors, CASE WHEN word_count < words THEN 'few_words' END, CASE WHEN character_count < characters THEN 'few_characters' END], lambda x: x IS NOT NULL), ' ') AS errors, coalesce(warnings, '') AS warnings
 FROM w LEFT JOIN e USING (doc_id)""")
def editorial_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of each text under the profile of its document's newest type."""
    judged = quality.by_profile(_typed(spark, sf_dir))
    return judged.select("doc_id", "profile", "score", F.array_join("errors", " ").alias("errors"), F.array_join("warnings", " ").alias("warnings"))


@query(f"WITH {ANOMALIES_SQL} SELECT doc_id, code, severity, message, n, ratio, array_to_string(coalesce(shown, []), ' | ') AS examples FROM an")
def anomaly_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an auditor reads first: each anomaly of each text with its message and examples of lines."""
    rows = _typed(spark, sf_dir)
    judged = quality.with_repeated(quality.by_profile(rows, examples=True), quality.repeated_lines(rows.select("doc_id", "text")))
    each = judged.select("doc_id", F.explode("anomalies").alias("a"))
    return each.select("doc_id", "a.code", "a.severity", "a.message", F.col("a.count").alias("n"), "a.ratio", F.array_join("a.examples", " | ").alias("examples"))


@query("WITH " + PROFILES_SQL.partition("limits(")[0].rstrip(",\n ") + """, st AS (SELECT document_id, max_by(document_type, updated_at) AS document_type FROM document GROUP BY document_id)
SELECT document_id, document_type, coalesce(profile, 'default') AS profile FROM st LEFT JOIN kinds USING (document_type)""")
def profile_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "document").groupBy("document_id").agg(F.max_by("document_type", "updated_at").alias("document_type"))
    return rows.withColumn("profile", quality.profile_of(F.col("document_type")))


@query("SELECT corpus_version, audit_profile, editorial_status, count(*)::BIGINT AS n, count(*) FILTER (approved)::BIGINT AS approved FROM editorial_audit GROUP BY ALL")
def audit_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.audit_counts(table(spark, sf_dir, "editorial_audit"))


@query(f"""SELECT doc_id, line, count(*)::BIGINT AS n, min(i) - 1 AS first_line FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, list_transform(regexp_split_to_array(text, '{RSL}'), lambda l: {strip_sql('l')}) AS ls FROM documents)) WHERE length(line) >= 5 GROUP BY doc_id, line HAVING count(*) >= 3""".replace("unnest(ls) AS line, unnest", "unnest(ls) AS line0, unnest").replace("SELECT doc_id, line, count", "SELECT doc_id, regexp_replace(line0, '[" + RWS + "]+', ' ', 'g') AS line, count").replace("length(line) >= 5", "length(line0) >= 5").replace("GROUP BY doc_id, line ", "GROUP BY ALL "))
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_lines(_documents(spark, sf_dir))


# states, records, statistics


@query("SELECT document_id, audit_id, editorial_score, approved FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY audit_id DESC, corpus_version DESC) AS rn FROM editorial_audit WHERE document_id IS NOT NULL) WHERE rn = 1")
def latest_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "editorial_audit").select("document_id", "audit_id", "corpus_version", "editorial_score", "approved")
    return corpus.latest_audits(rows).select("document_id", "audit_id", "editorial_score", "approved")


@query("""SELECT corpus_version, coalesce(document_type, 'sin_clasificar') AS document_type, count(*)::BIGINT AS documents, sum(anomaly_report.word_count)::BIGINT AS words, sum(anomaly_report.character_count)::BIGINT AS characters,
 sum(editorial_score)::BIGINT AS score_sum, round_even(avg(editorial_score), 2) AS average_score, count(*) FILTER (approved)::BIGINT AS approved FROM editorial_audit GROUP BY ALL""")
def corpus_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.statistics(table(spark, sf_dir, "editorial_audit"))


@query(f"""WITH d AS (SELECT DISTINCT document_id, original_path FROM document WHERE original_path IS NOT NULL),
r AS (SELECT local_path, oai_datestamp, identifier, title, authors, row_number() OVER (PARTITION BY local_path ORDER BY oai_datestamp DESC NULLS LAST, identifier DESC, title DESC NULLS LAST) AS rn FROM remote_record WHERE local_path IS NOT NULL)
SELECT document_id, coalesce(r.title, regexp_replace(regexp_extract(original_path, '[^/]*$'), '\\.[^.]*$', '')) AS record_title, r.local_path IS NOT NULL AS recorded FROM d LEFT JOIN r ON r.local_path = d.original_path AND rn = 1""")
def records_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "document").where("original_path is not null").select("document_id", "original_path").distinct()
    return corpus.with_record(documents, table(spark, sf_dir, "remote_record"), ["oai_datestamp", "identifier"]).select("document_id", "record_title", "recorded")


@query("""WITH old AS (SELECT document_id, min_by(title, updated_at) AS title, min(created_at) AS created_at, min(updated_at) AS updated_at FROM document GROUP BY document_id HAVING count(DISTINCT updated_at) > 1 OR min(status) <> 'CANONICAL'),
new AS (SELECT document_id, max_by(title, updated_at) AS title, max(created_at) AS created_at, max(updated_at) AS updated_at FROM document GROUP BY document_id)
SELECT document_id, CASE WHEN new.document_id IS NULL THEN old.title ELSE new.title END AS title, epoch_us(coalesce(old.created_at, new.created_at)) AS created_us, epoch_us(coalesce(new.updated_at, old.updated_at)) AS updated_us FROM old FULL JOIN new USING (document_id)""")
def document_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest states written over the oldest of part of the documents; the time of creation stays."""
    rows = table(spark, sf_dir, "document").groupBy("document_id").agg(
        F.min_by("title", "updated_at").alias("old_title"), F.max_by("title", "updated_at").alias("title"), F.min("created_at").alias("old_created"), F.max("created_at").alias("created_at"),
        F.min("updated_at").alias("old_updated"), F.max("updated_at").alias("updated_at"), F.countDistinct("updated_at").alias("states"), F.min("status").alias("status"),
    )
    old = rows.where("states > 1 or status != 'CANONICAL'").select("document_id", F.col("old_title").alias("title"), F.col("old_created").alias("created_at"), F.col("old_updated").alias("updated_at"))
    after = corpus.upserted(old, rows.select("document_id", "title", "created_at", "updated_at"), "document_id", ("created_at",))
    return after.select("document_id", "title", F.unix_micros("created_at").alias("created_us"), F.unix_micros("updated_at").alias("updated_us"))


@query("SELECT coalesce(language, '(vacío)') AS language, count(*)::BIGINT AS n FROM remote_record GROUP BY ALL")
def language_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.histogram(table(spark, sf_dir, "remote_record"), "language")


@query("SELECT source_code, count(*) FILTER (acquisition_status = 'DOWNLOADED')::BIGINT AS downloaded, count(*) FILTER (acquisition_status = 'DOWNLOAD_ERROR')::BIGINT AS download_error, count(*) FILTER (acquisition_status = 'REJECTED_LANGUAGE')::BIGINT AS rejected_language, count(*)::BIGINT AS all_rows FROM remote_record GROUP BY source_code")
def acquisition_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.status_counts(table(spark, sf_dir, "remote_record"), "source_code", "acquisition_status", ["DOWNLOADED", "DOWNLOAD_ERROR", "REJECTED_LANGUAGE"])


@query(f"""SELECT identifier, oai_datestamp, coalesce(lower({strip_sql('language')}) IN ('es', 'esp', 'spa', 'spanish', 'español', 'espanol') OR regexp_matches(lower({strip_sql('language')}), '^es[-_]'), false) AS spanish,
 coalesce(contains(lower(resource_type), 'article') OR contains(lower(resource_type), 'artículo') OR contains(lower(resource_type), 'articulo'), true) AS article,
 coalesce(list_filter(w, lambda i: contains(i, 'script=sci_arttext'))[1], list_filter(w, lambda i: contains(lower(i), 'scielo'))[1], w[1]) AS address, list_filter(w, lambda i: regexp_matches(lower(i), '\\.pdf($|\\?)') OR contains(i, 'script=sci_pdf'))[1] AS pdf,
 len(list_filter(list_transform(authors, lambda a: {strip_sql('a')}), lambda a: a <> ''))::BIGINT AS authors FROM (SELECT DISTINCT identifier, oai_datestamp, language, resource_type, list_filter(list_transform(identifiers, lambda i: {strip_sql('i')}), lambda i: regexp_matches(i, '^https?://')) AS w, authors FROM remote_record)""")
def record_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "remote_record").select("identifier", "oai_datestamp", "language", "resource_type", "identifiers", "authors").distinct()
    authors = F.when(F.col("authors").isNotNull(), F.size(F.filter(F.transform("authors", T.strip), lambda a: a != "")).cast("long"))
    return rows.select(
        "identifier", "oai_datestamp", metadata.is_spanish(F.col("language")).alias("spanish"), metadata.is_article(F.col("resource_type")).alias("article"),
        metadata.article_address(F.col("identifiers")).alias("address"), metadata.pdf_address(F.col("identifiers")).alias("pdf"), authors.alias("authors"),
    )


@query("""WITH a AS (SELECT document_id, editorial_score, approved FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY audit_id DESC, corpus_version DESC) AS rn FROM editorial_audit WHERE document_id IS NOT NULL) WHERE rn = 1)
SELECT doc_id, document_id, editorial_score FROM documents JOIN a USING (document_id) WHERE approved AND editorial_score >= 80""")
def audited_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    audits = table(spark, sf_dir, "editorial_audit").select("document_id", "audit_id", "corpus_version", "editorial_score", "approved")
    return corpus.audited(_documents(spark, sf_dir).select("doc_id", "document_id"), audits, 80)


@query("SELECT value, count(*)::BIGINT AS n FROM (SELECT unnest(subjects) AS value FROM remote_record) WHERE value IS NOT NULL GROUP BY value ORDER BY n DESC, value LIMIT 100")
def common_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "remote_record").select(F.filter("subjects", lambda s: s.isNotNull()).alias("subjects"))
    return corpus.most_common(records, "subjects", 100)


@query("""WITH s AS (SELECT DISTINCT document_id, source_code, canonical_path, original_path FROM document), e AS (SELECT DISTINCT canonical_path AS path FROM document WHERE status = 'CANONICAL' UNION SELECT DISTINCT local_path FROM remote_record),
w AS (SELECT document_id, unnest([canonical_path, 'data/canonical/' || source_code || '/' || document_id || '.txt', original_path]) AS path, unnest([0, 1, 2]) AS way FROM s)
SELECT document_id, arg_min(e.path, way) FILTER (e.path IS NOT NULL) AS path FROM w LEFT JOIN e USING (path) GROUP BY document_id""")
def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "document")
    existing = documents.where("status = 'CANONICAL'").select(F.col("canonical_path").alias("path")).union(table(spark, sf_dir, "remote_record").select("local_path")).where("path is not null")
    return corpus.resolved_paths(documents.select("document_id", "source_code", "canonical_path", "original_path").distinct(), existing)


# recovery


@query(f"""WITH e AS (SELECT document_id AS document, text FROM documents), raw AS (SELECT 'f' || doc_id AS file, CASE WHEN doc_id % 3 = 0 THEN upper(text) WHEN doc_id % 3 = 1 THEN text || chr(10) || chr(10) ELSE text END AS text FROM documents),
h AS (SELECT sha256(text) AS k, count(*) AS n, min(document) AS document FROM e GROUP BY 1), s AS (SELECT {strip_sql(f'''regexp_replace(lower(text), '[{RWS}]+', ' ', 'g')''')} AS k, min(document) AS document FROM e GROUP BY 1 HAVING count(*) = 1),
j AS (SELECT raw.file, CASE WHEN h.n = 1 THEN h.document END AS d1, CASE WHEN h.n IS NULL THEN 'UNMATCHED' WHEN h.n > 1 THEN 'AMBIGUOUS' ELSE 'MATCHED' END AS st, s.document AS d2 FROM raw LEFT JOIN h ON h.k = sha256(raw.text) LEFT JOIN s ON substr(s.k, 1, 5000) = substr({strip_sql(f'''regexp_replace(lower(raw.text), '[{RWS}]+', ' ', 'g')''')}, 1, 5000))
SELECT file, coalesce(d1, d2) AS document, CASE WHEN st = 'MATCHED' THEN st WHEN d2 IS NOT NULL THEN 'RECOVERED' ELSE st END AS status FROM j""")
def mapping_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose texts differ in case or line ends from the extracted ones, mapped by hash and then by likeness."""
    documents = spread(_documents(spark, sf_dir).select("doc_id", "document_id", "text"))
    text = F.when(F.col("doc_id") % 3 == 0, F.upper("text")).when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("\n\n"))).otherwise(F.col("text"))
    raw, extracted = documents.select(F.concat(F.lit("f"), "doc_id").alias("file"), text.alias("text")), documents.select(F.col("document_id").alias("document"), "text")
    return recovery.merged_mapping(recovery.by_hash(raw, extracted), recovery.by_likeness(raw, extracted))


SEGMENTS = [("a", 1, 10), ("a", 1, 12), ("a", 5, 9), ("a", 13, 20), ("b", 1, 10), ("b", 12, 20), ("b", 15, 30), ("b", 21, 22)]


# web pages and wikitext made of titles and records

PAGES_SQL = """pages AS (SELECT DISTINCT identifier AS page, '<html><head><script src="/js/' || coalesce(nullif(regexp_extract(identifier, '[0-9]+$'), ''), 'a') || '.js"></script><script src="https://cdn.example/b.js"></script><meta name="citation_pdf_url" content="' || coalesce(pdf_url, '') || '"></head>' || chr(10) || '<body><style>p {}</style><h1>' || title || '</h1>' || chr(10) || '<a href="articulo.oa?id=' || regexp_extract(identifier, '[0-9]+$') || '">Leer</a> <a href="articulo.oa?id=7">Otro &amp; m&#225;s</a></body></html>' AS html FROM remote_record WHERE title IS NOT NULL AND oai_datestamp IS NOT NULL)"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "remote_record").where("title is not null and oai_datestamp is not null")
    html = F.concat(
        F.lit('<html><head><script src="/js/'), F.coalesce(F.nullif(F.regexp_extract("identifier", "[0-9]+$", 0), F.lit("")), F.lit("a")), F.lit('.js"></script><script src="https://cdn.example/b.js"></script><meta name="citation_pdf_url" content="'), F.coalesce("pdf_url", F.lit("")), F.lit('"></head>\n<body><style>p {}</style><h1>'), F.col("title"),
        F.lit('</h1>\n<a href="articulo.oa?id='), F.regexp_extract("identifier", "[0-9]+$", 0), F.lit('">Leer</a> <a href="articulo.oa?id=7">Otro &amp; m&#225;s</a></body></html>'),
    )
    return r.select(F.col("identifier").alias("page"), html.alias("html")).distinct()


@query("WITH " + PAGES_SQL + """ SELECT page, html AS h, list_sort(list_distinct(regexp_extract_all(html, 'articulo\\.oa\\?id=([0-9]+)', 1)))[1] AS first_id, len(list_distinct(regexp_extract_all(html, 'articulo\\.oa\\?id=([0-9]+)', 1)))::BIGINT AS ids,
 nullif(regexp_extract(html, 'content="([^"]*)"', 1), '') AS citation, nullif(regexp_extract(html, 'https?://[^\\s"''<>]+\\.pdf'), '') AS pdf, 'https://x.example/js/' || coalesce(nullif(regexp_extract(page, '[0-9]+$'), ''), 'a') || '.js' AS scripts FROM pages""".replace("html AS h, ", ""))
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("html")
    return _pages(spark, sf_dir).select(
        "page", F.get(metadata.link_ids(h), F.lit(0)).alias("first_id"), F.size(metadata.link_ids(h)).cast("long").alias("ids"), metadata.citation_pdf(h, F.lit(None)).alias("citation"),
        metadata.pdf_link(h).alias("pdf"), F.array_join(metadata.script_sources(h, "x.example", ("jquery",)), " ").alias("scripts"),
    )


@query("WITH " + PAGES_SQL + """ SELECT page, (i + 1)::BIGINT AS line_no, substr(trim(regexp_replace(line, '\\s+', ' ', 'g')), 1, 500) AS line FROM (SELECT page, unnest(l) AS line, unnest(range(0, len(l))) AS i FROM (SELECT page, string_split(html, chr(10)) AS l FROM pages)) WHERE contains(lower(line), 'leer') OR contains(lower(line), 'citation')""")
def html_keyword_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.keyword_lines(_pages(spark, sf_dir), "page", "html", ["leer", "CITATION"])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

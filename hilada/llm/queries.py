"""The queries of the problems on training text, each (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, leakage, mixing, mojibake, quality, residue, sql, subjects, term_counts, token_counts
from .common import newest, salted_join, spread, table, written

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def _newest_document(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return newest(table(spark, sf_dir, "document"), "document_id", "updated_at", *columns)


# 1: subject areas

#: Share of what is specific from which an area counts; specific words in a code point from which a text treats any area.
AREA_SHARE, AREA_DENSITY = 0.2, 0.004


def _subjects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Mixtures of the documents that are prose, areas that their records name, and the names of the areas."""
    no_prose = _no_prose(spark, sf_dir)
    documents = _documents(spark, sf_dir).select("doc_id", "document_id", "lang", "text").join(no_prose, "doc_id", "left_anti")
    areas = table(spark, sf_dir, "subject_area").where("area is not null")
    records = newest(table(spark, sf_dir, "remote_record").where("identifier is not null"), "identifier", "oai_datestamp", "subjects", "local_path")
    records = written(records.where("subjects is not null and size(subjects) > 0").select("subjects", "local_path"))
    meaning = written(subjects.subject_areas(records, areas))
    paths = _newest_document(spark, sf_dir, "original_path").where("original_path is not null").select("document_id", F.col("original_path").alias("local_path"))
    named = salted_join(subjects.named_subjects(records.where("local_path is not null")), meaning, "subject").join(paths, "local_path")
    named = written(named.join(documents.select("doc_id", "document_id"), "document_id").groupBy("doc_id", "area").agg(F.lit(1.0).alias("weight")))
    by_hand = table(spark, sf_dir, "subject_label").where("doc_id is not null and area is not null").select("doc_id", "area", F.lit(2.0).alias("weight")).distinct()
    rows = [(r.area, r.area_name or "", r.description or "") for r in areas.select("area", "area_name", "description").orderBy("area").collect()]
    return subjects.subject_mixtures(documents, rows, named.unionByName(by_hand)), named, [r[0] for r in rows]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixtures, named, names = _subjects(spark, sf_dir)
    mixtures = written(mixtures)
    treats = F.col("specific") >= AREA_DENSITY * F.col("length")
    each = mixtures.where(treats & (F.col("specific") > 0)).select("doc_id", F.posexplode("shares").alias("i", "share"))
    treated = each.where(F.col("share") >= AREA_SHARE).select("doc_id", F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("area"))
    others = mixtures.where(~treats | (F.col("specific") <= 0)).select("doc_id").join(named, "doc_id").select("doc_id", "area")
    return treated.unionByName(others).distinct()


# 2: frequency of every distinct word


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts.marks(_documents(spark, sf_dir), table(spark, sf_dir, "lexical_frequency"))


def p2_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = term_counts.term_counts(_documents(spark, sf_dir), "text")
    return counts.select(F.col("term").alias("word"), "absolute_frequency", "document_frequency")


def p2_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of up to three words that isn't rare, in the sense of p2_found: at least 3 documents have it."""
    counts = term_counts.term_counts(_documents(spark, sf_dir), "text", length=3).where("document_frequency >= 3")
    return counts.select("term", "absolute_frequency", "document_frequency")


# 3: languages

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Labelled texts of each language from which the model is trained.
SAMPLE = 400


def _no_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of the documents found by p5 or p9, as a table."""
    return written(residue.no_prose(_documents(spark, sf_dir)))


def _language_model(texts: DataFrame, pieces: str = PIECES, sample: int = SAMPLE) -> language.Model:
    rows = language.sampled(texts, "document_id", "label", "text", sample)
    return language.train(rows, language.public_pieces(pieces))


def _languages(spark: SparkSession, sf_dir: str, no_prose: DataFrame) -> tuple[DataFrame, language.Model]:
    """Texts with their claimed language, and the model learned from those that are prose."""
    texts = _documents(spark, sf_dir).where("document_id is not null").select("doc_id", "document_id", "text", F.col("lang").alias("label"))
    return texts, _language_model(texts.join(no_prose, "doc_id", "left_anti"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and records are judged where they lie; only what is judged, a few small columns, meets the newest labels."""
    no_prose = _no_prose(spark, sf_dir)
    texts, model = _languages(spark, sf_dir, no_prose)
    state = written(_newest_document(spark, sf_dir, "language", "original_path").select("document_id", language.codes("language").alias("label"), "original_path"))

    judged = language.document_languages(texts, model, carry=("doc_id",)).where("segment_no = 0 or (running and language != main)").select("doc_id", "document_id", "segment_no", "language")
    judged = written(judged.join(no_prose, "doc_id", "left_anti"))
    whole = judged.where("segment_no = 0").join(state.select("document_id", "label"), "document_id", "left").where("label is null or label != language")
    of_documents = whole.select("document_id", "segment_no", "language").unionByName(judged.where("segment_no > 0").select("document_id", "segment_no", "language"))
    of_documents = of_documents.select(F.lit("document").alias("record_type"), F.col("document_id").alias("record_key"), "segment_no", "language")

    records = table(spark, sf_dir, "remote_record").where("identifier is not null")
    titled = F.col("title").isNotNull() & (F.trim("title") != "")
    text = F.when(titled, F.concat_ws(" . ", "title", F.get("descriptions", F.lit(0))))
    records = records.select("identifier", "oai_datestamp", language.codes("language").alias("label"), text.alias("text"), "local_path")
    shown = language.record_languages(records.withColumn("claimed", F.col("label")), model, carry=("oai_datestamp", "claimed", "local_path"))
    shown = newest(shown, "identifier", "oai_datestamp", "claimed", "shown", "local_path").where("shown is not null and (claimed is null or claimed != shown)")
    shown = shown.withColumn("local_path", F.coalesce("local_path", F.concat(F.lit("no path of "), "identifier")))  # else all records without a path meet in one task
    texts_of = _documents(spark, sf_dir).select("doc_id", "document_id").join(no_prose, "doc_id", "left_semi")
    linked = texts_of.join(state.where("original_path is not null"), "document_id").select(F.col("original_path").alias("local_path")).distinct()
    wrong = shown.join(linked, "local_path", "left_anti")
    of_records = wrong.select(F.lit("remote").alias("record_type"), F.col("identifier").alias("record_key"), F.lit(0).alias("segment_no"), F.col("shown").alias("language"))
    return of_documents.unionByName(of_records).distinct()


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text (segment 0) and paragraph of prose with its language and confidence."""
    no_prose = _no_prose(spark, sf_dir)
    texts, model = _languages(spark, sf_dir, no_prose)
    judged = language.document_languages(texts, model, carry=("doc_id",)).join(no_prose, "doc_id", "left_anti")
    return judged.select("document_id", "segment_no", "language", F.round("confidence", 4).alias("confidence"), "words")


# 4: tokens


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), table(spark, sf_dir, "token_vocabulary"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir)


def p4_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _newest_document(spark, sf_dir, "thematic_domain")
    return token_counts.token_totals(_tokens(spark, sf_dir), _documents(spark, sf_dir), state)


# 5 and 9: text that is no prose


def _residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(_documents(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that fail a rule and aren't residue; one pass gives both."""
    documents = _documents(spark, sf_dir)
    found = written(residue.templates_of(documents, quality.common_words(documents)))
    return found.where("template is null").select("doc_id").distinct().join(residue.judged(found), "doc_id", "left_anti")


def p5_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_statistics(_documents(spark, sf_dir)).withColumn("failures", F.array_join("failures", "; "))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _residue(spark, sf_dir).select("doc_id")


def p9_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that remain, by source."""
    return residue.without_residue(_documents(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_chars").alias("n_chars"))


# 6: wrong encodings


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _documents(spark, sf_dir).select(F.lit("text").alias("field"), "document_id", "text")
    titles = _newest_document(spark, sf_dir, "title").select(F.lit("title").alias("field"), "document_id", F.col("title").alias("text"))
    return mojibake.damaged(texts.unionByName(titles))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.with_md5(_damaged(spark, sf_dir))


# 7: evaluation passages


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "evaluation_item"), _documents(spark, sf_dir)).select("item_id", "doc_id").distinct()


def p7_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = leakage.without_leaks(table(spark, sf_dir, "evaluation_item"), _documents(spark, sf_dir))
    return cleaned.select("doc_id", F.length("text").cast("long").alias("n_chars"))


# 8: mixing


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document with its place in the tree of domains, languages and sources."""
    domains = _newest_document(spark, sf_dir, "thematic_domain").select("document_id", F.lower(F.trim("thematic_domain")).alias("domain"))
    placed = _documents(spark, sf_dir).select("doc_id", "document_id", "source", F.col("lang").alias("language")).join(domains, "document_id", "left")
    return _tokens(spark, sf_dir).join(placed.drop("document_id"), "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    budgets = mixing.mix_budgets(table(spark, sf_dir, "mix_target"), mixing.source_profile(_sliced(spark, sf_dir)))
    return budgets.where("not reachable").select("mix_id", "source_code").distinct()


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share each source reaches with the documents that are really taken."""
    tokens = written(_sliced(spark, sf_dir))
    budgets = written(mixing.mix_budgets(table(spark, sf_dir, "mix_target"), mixing.source_profile(tokens)))
    taken = mixing.mix_selection(budgets, tokens).groupBy("mix_id", "source_code").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("taken_tokens"))
    taken = budgets.select("mix_id", "source_code", "target_share").distinct().join(taken, ["mix_id", "source_code"], "left").fillna({"taken_tokens": 0})
    whole = taken.groupBy("mix_id").agg(F.sum("taken_tokens").alias("all_tokens"))
    return taken.join(whole, "mix_id").select("mix_id", "source_code", "target_share", "taken_tokens", F.coalesce(F.try_divide("taken_tokens", "all_tokens"), F.lit(0.0)).alias("reached_share"))


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each mix and source, what the budgets and the documents taken must keep: no more than max_repeats times the tokens, the
    whole target where it is reachable, and no leaf short of its budget by as much as its longest document."""
    tokens = written(_sliced(spark, sf_dir))
    budgets = written(mixing.mix_budgets(table(spark, sf_dir, "mix_target"), mixing.source_profile(tokens)))
    at = ["mix_id", "source_code", "domain", "language"]
    longest = tokens.groupBy(F.col("source").alias("source_code"), F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("language", F.lit("")).alias("language")).agg(F.max("n_tokens").alias("longest"))
    taken = mixing.mix_selection(budgets, tokens).groupBy(*at).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("taken"), F.max("copies").alias("copies"))
    leaf = budgets.join(taken, at, "left").join(longest, at[1:], "left").fillna({"taken": 0, "copies": 0, "longest": 0})
    filled = F.bool_and((F.col("taken") <= F.col("granted_tokens") + 1e-3) & (F.col("taken") + F.col("longest") >= F.col("granted_tokens") - 1e-3))
    return leaf.groupBy("mix_id", "source_code").agg(
        F.sum("tokens").alias("tokens"), F.bool_and("reachable").alias("reachable"), (F.max("copies") <= F.max("max_repeats")).alias("within_repeats"), filled.alias("filled"),
        (F.sum("granted_tokens") >= F.least(F.max("target_share") * F.max("total_tokens"), F.sum(F.col("max_repeats") * F.col("tokens"))) - 1e-3).alias("has_target"),
    )


def p1_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the corpus consists of: by source and area, the documents and the code points of their parts.

    All documents are in it: those whose areas come from their record share their text evenly among them, and those that have no
    area, or are no prose, count under a null one. So the code points of a source add up to those of its texts.
    """
    mixtures, named, names = _subjects(spark, sf_dir)
    mixtures = written(mixtures)
    treats = (F.col("specific") > 0) & (F.col("specific") >= AREA_DENSITY * F.col("length"))
    each = mixtures.where(treats).select("doc_id", F.posexplode("shares").alias("i", "share")).where(F.col("share") >= AREA_SHARE)
    treated = each.select("doc_id", F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("area"), "share")
    others = mixtures.where(~treats).select("doc_id").join(named, "doc_id").select("doc_id", "area", F.lit(1.0).alias("share"))
    parts = treated.unionByName(others)
    parts = parts.join(parts.groupBy("doc_id").agg(F.sum("share").alias("all")), "doc_id").select("doc_id", "area", (F.col("share") / F.col("all")).alias("share"))
    documents = _documents(spark, sf_dir).select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("length"))
    placed = documents.join(parts, "doc_id", "left").withColumn("share", F.coalesce("share", F.lit(1.0)))
    return placed.groupBy("source", "area").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.col("share") * F.col("length")).alias("code_points"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(sql.SQL)

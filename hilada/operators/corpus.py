"""From texts to a corpus: ingest, exact duplicates, validation, newest states, joins of records, statistics, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def first_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that comes first by the columns of order; an aggregate, so nothing of a key has to fit one task."""
    rest = [c for c in df.columns if c not in (key, *order)]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(key).agg(best).select(*(F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns))


def last_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that comes last by the columns of order, ties by all others."""
    rest = [c for c in df.columns if c not in (key, *order)]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(key).agg(best).select(*(F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns))


def exact_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, sha256, kept): of equal texts the first by key is kept. Null texts are equal to none.

    The hash stands for the text: the first key of each hash is an aggregate of two narrow columns, joined back to keys.
    """
    hashed = documents.select(key, F.sha2(F.col(text), 256).alias("sha256"))
    first = hashed.where("sha256 is not null").groupBy("sha256").agg(F.min(key).alias("_first"))
    return hashed.join(first, "sha256", "left").select(key, "sha256", (F.col("_first").isNull() | (F.col("_first") == F.col(key))).alias("kept"))


def new_only(incoming: DataFrame, registered: DataFrame, on: str) -> DataFrame:
    """Incoming rows whose key isn't registered."""
    return incoming.join(registered.select(on).distinct(), on, "left_anti")


def first_new(incoming: DataFrame, registered: DataFrame, on: str, order: str, most: int | None) -> DataFrame:
    """new_only, and of those the first `most` by order; None or 0 takes all."""
    new = new_only(incoming, registered, on)
    return new.orderBy(order).limit(most) if most else new


def validated(df: DataFrame, text: str = "text", characters: int = 1000, words: int = 200) -> DataFrame:
    """Adds errors and warnings: too short, too few words, NUL characters; replacement characters only warn."""
    t = F.coalesce(F.col(text), F.lit(""))
    errors = F.array(
        F.when(T.strip(t) == "", F.lit("empty")), F.when(F.length(t) < characters, F.lit("few characters")), F.when(T.word_count(t) < words, F.lit("few words")),
        F.when(F.instr(t, "\x00") > 0, F.lit("NUL characters")),
    )
    return df.withColumns({"errors": F.array_join(F.filter(errors, lambda e: e.isNotNull()), "; "), "warnings": F.when(F.instr(t, "\ufffd") > 0, F.lit("replacement characters")).otherwise("")})


def ingested(documents: DataFrame, registered: DataFrame | None = None, limits: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Rows (doc_id, source, sha256, canonical_sha256, characters, words, paragraphs, errors) of the first of each text.

    Clean, normalized and canonical forms are columns of one projection; limits gives sources other least characters and words.
    """
    rows = documents.select("doc_id", "source", "text")
    rows = rows.join(exact_duplicates(rows).where("kept").select("doc_id", "sha256"), "doc_id")
    if registered is not None:
        rows = new_only(rows, registered, "sha256")
    rows = rows.withColumn("canonical", T.canonical(T.normalize(T.clean(F.col("text")))))
    least_c, least_w = F.lit(1000), F.lit(200)
    for source, (c, w) in (limits or {}).items():
        least_c, least_w = F.when(F.col("source") == source, c).otherwise(least_c), F.when(F.col("source") == source, w).otherwise(least_w)
    text = F.col("canonical")
    errors = F.array(F.when(T.strip(text) == "", F.lit("empty")), F.when(F.length(text) < least_c, F.lit("few characters")), F.when(T.word_count(text) < least_w, F.lit("few words")))
    return rows.select(
        "doc_id", "source", "sha256", F.sha2(text, 256).alias("canonical_sha256"), F.length(text).cast("long").alias("characters"), T.word_count(text).alias("words"),
        T.paragraph_count(text).alias("paragraphs"), F.array_join(F.filter(errors, lambda e: e.isNotNull()), "; ").alias("errors"),
    )


def upserted(current: DataFrame, incoming: DataFrame, key: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """The table after an upsert: incoming rows replace those of their key, but keep the columns `kept` of the current ones.

    incoming has one row for each key. One full outer join, which rewrites the table, as Parquet has no updates.
    """
    old, new = current.withColumn("_old", F.lit(True)).alias("o"), incoming.withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    columns = []
    for c in current.columns:
        keep = F.col("o._old") if c in kept else F.col("n._new").isNull()
        columns.append(F.when(keep, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}") if c in incoming.columns else F.col(f"o.{c}")).alias(c))
    return joined.select(*columns)


def with_record(documents: DataFrame, records: DataFrame, order: list[str]) -> DataFrame:
    """Documents with title, authors and subjects of their record, the last by order where several have the path.

    Documents without a record have the stem of their file name as title and recorded false.
    """
    last = last_of(records.where("local_path is not null").select("local_path", *order, "title", "authors"), "local_path", order)
    last = last.select(F.col("local_path").alias("original_path"), F.col("title").alias("record_title"), F.array_join("authors", "; ").alias("record_authors"), F.lit(True).alias("recorded"))
    stem = F.regexp_replace(F.element_at(F.split("original_path", "/"), -1), "\\.[^.]*$", "")
    joined = documents.join(last, "original_path", "left")
    return joined.withColumns({"record_title": F.coalesce("record_title", stem), "recorded": F.coalesce("recorded", F.lit(False))})


def latest_audits(audits: DataFrame, version: str | None = None) -> DataFrame:
    """The audit of each document with the greatest audit_id, of one corpus version if it is given."""
    rows = audits if version is None else audits.where(F.col("corpus_version") == version)
    return last_of(rows.where("document_id is not null"), "document_id", ["audit_id"])


def statistics(audits: DataFrame) -> DataFrame:
    """By corpus version and document type (sin_clasificar where there is none): documents, words, characters and scores, the
    average rounded to two decimals, ties to even."""
    kind = F.coalesce("document_type", F.lit("sin_clasificar"))
    return audits.groupBy("corpus_version", kind.alias("document_type")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("anomaly_report.word_count").alias("words"), F.sum("anomaly_report.character_count").alias("characters"),
        F.sum("editorial_score").alias("score_sum"), T.half_even(F.avg("editorial_score")).alias("average_score"), F.count_if("approved").alias("approved"),
    )


def manifest_entries(documents: DataFrame, version: str) -> DataFrame:
    """One row for each document of a version: key, hash and size of its text, and a hash of the whole entry."""
    rows = documents.select("doc_id", "source", F.lit(version).alias("version"), F.sha2("text", 256).alias("sha256"), F.length("text").cast("long").alias("characters"), T.word_count(F.col("text")).alias("words"))
    return rows.withColumn("entry_sha256", F.sha2(F.concat_ws("\u0001", "source", "version", F.col("doc_id").cast("string"), "sha256"), 256))


def manifest(entries: DataFrame) -> DataFrame:
    """Rows (source, version, documents, words, characters, entries_sha256) of entries: by source, sizes and one hash of all.

    The hash is made of the sums of the eight parts of the entries' digests, so it needs no order and no group in one task, and
    repeated entries count.
    """
    parts = [F.sum(F.conv(F.substring("entry_sha256", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")) for i in range(8)]
    return entries.groupBy("source", "version").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"), F.sum("characters").alias("characters"), F.sha2(F.concat_ws("-", *(p.cast("string") for p in parts)), 256).alias("entries_sha256")
    )


def consolidate(documents: DataFrame, path: str, version: str) -> DataFrame:
    """Writes the texts of a version, in one directory for each source, and its manifest; what the version held of these sources
    before is replaced. Returns the manifest as it was written."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(f"{path}/{version}/texts")
    written = documents.sparkSession.read.parquet(f"{path}/{version}/texts")
    entries = manifest_entries(written, version)
    entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(f"{path}/{version}/entries")
    return manifest(documents.sparkSession.read.parquet(f"{path}/{version}/entries"))


def status_counts(df: DataFrame, source: str, status: str, values: list[str]) -> DataFrame:
    """By source, the number of rows of each status, one column each."""
    return df.groupBy(source).agg(*(F.count_if(F.col(status) == v).alias(v.lower()) for v in values), F.count(F.lit(1)).alias("all_rows"))


def histogram(df: DataFrame, column: str, empty: str = "(vacío)") -> DataFrame:
    return df.groupBy(F.coalesce(column, F.lit(empty)).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def audited(documents: DataFrame, audits: DataFrame, least_score: int, version: str | None = None) -> DataFrame:
    """Documents whose latest audit approved them with at least the score, with that score."""
    last = latest_audits(audits, version).where(F.col("approved") & (F.col("editorial_score") >= least_score))
    return documents.join(last.select("document_id", "editorial_score"), "document_id")


def resolved_paths(documents: DataFrame, existing: DataFrame, required: bool = False) -> DataFrame:
    """Rows (document_id, path): the first of canonical_path, the path made of source and id, and original_path that exists.

    existing: the paths there are. One join whatever the number of ways; path is null where none exists, or an error if required.
    """
    made = F.concat(F.lit("data/canonical/"), "source_code", F.lit("/"), "document_id", F.lit(".txt"))
    ways = F.array(F.col("canonical_path"), made, F.col("original_path"))
    each = documents.select("document_id", F.posexplode(ways).alias("way", "path")).join(existing.select("path", F.lit(True).alias("found")).distinct(), "path", "left")
    best = F.min(F.when(F.col("found"), F.struct("way", "path"))).alias("best")
    path = F.col("best.path")
    if required:
        path = F.coalesce(path, F.raise_error(F.concat(F.lit("no text of "), "document_id")).cast("string"))
    return each.groupBy("document_id").agg(best).select("document_id", path.alias("path"))


def most_common(df: DataFrame, column: str, most: int) -> DataFrame:
    """The most frequent elements of an array column, ties by value."""
    each = df.select(F.explode(column).alias("value"))
    return each.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(most)


def audit_counts(audits: DataFrame) -> DataFrame:
    """Audits by version, profile and editorial status, nulls as groups of their own, and how many of them approve."""
    return audits.groupBy("corpus_version", "audit_profile", "editorial_status").agg(F.count(F.lit(1)).alias("n"), F.count_if("approved").alias("approved"))


def reprocessed(documents: DataFrame) -> DataFrame:
    """Stored normalized texts in canonical form again, with fresh measures and hash; doing it twice changes nothing more."""
    text = T.canonical(F.col("text"))
    return documents.withColumn("text", text).select(
        *documents.columns, F.sha2("text", 256).alias("canonical_sha256"), T.word_count(F.col("text")).alias("word_count"), F.length("text").cast("long").alias("character_count"), T.paragraph_count(F.col("text")).alias("paragraph_count")
    )

"""What the kind of a source says of its documents, and what their records and file names add."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .corpus import last_of

# By kind of source, the domain and the type of its documents; known works by a part of their file name, in this order.
KINDS = {
    "scientific": ("cientifico", "articulo_cientifico"),
    "encyclopedia": ("general", "articulo_enciclopedico"),
    "news": ("general", "articulo_prensa"),
    "literary": ("literatura", "obra_literaria"),
}
KNOWN_WORKS = {
    "quijote": ("El ingenioso hidalgo don Quijote de la Mancha", "Miguel de Cervantes Saavedra", "novela"),
    "lazarillo": ("La vida de Lazarillo de Tormes y de sus fortunas y adversidades", "Anónimo", "novela_picaresca"),
    "burlador": ("El burlador de Sevilla y convidado de piedra", "Atribuido a Tirso de Molina", "obra_dramatica"),
    "celestina": ("La Celestina", "Fernando de Rojas", "obra_dialogada"),
}


def stem(path: Column) -> Column:
    """The name of a file without its directory and last extension; a name that begins with its only dot stays."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, "(?<=.)\\.[^.]*$", "")


def downloaded(records: DataFrame, statuses: tuple[str, ...] = ("DOWNLOADED",)) -> DataFrame:
    """Records with one of the statuses and a path."""
    return records.where(F.col("acquisition_status").isin(*statuses) & (F.coalesce("local_path", F.lit("")) != ""))


def from_records(documents: DataFrame, records: DataFrame, kind: str, order: list[str]) -> DataFrame:
    """Documents (document_id, original_path) with language, thematic_domain, document_type, title, author and recorded.

    Of several records of a path the last by `order` holds. A document without a record, or with one without title, is named by
    its file; only scientific articles have authors. Records that aren't of `downloaded` should be left out before.
    """
    domain, document_type = KINDS[kind]
    last = last_of(records.where("local_path is not null").select("local_path", *order, "title", "authors"), "local_path", order)
    last = last.select(F.col("local_path").alias("original_path"), F.col("title").alias("_title"), "authors", F.lit(True).alias("recorded"))
    joined = documents.select("document_id", "original_path").join(last, "original_path", "left")
    author = F.nullif(F.array_join("authors", "; "), F.lit("")) if kind == "scientific" else F.lit(None).cast("string")
    return joined.select(
        "document_id", F.lit("es").alias("language"), F.lit(domain).alias("thematic_domain"), F.lit(document_type).alias("document_type"),
        F.coalesce(F.nullif("_title", F.lit("")), stem(F.col("original_path"))).alias("title"), author.alias("author"), F.coalesce("recorded", F.lit(False)).alias("recorded"),
    )


def literary(documents: DataFrame) -> DataFrame:
    """Documents (document_id, original_path, title) with language, thematic_domain, document_type, title and author.

    A known work is told by the first key that its file name contains, in any case and with signs for blanks; any other keeps its
    title or is named by its file.
    """
    domain, document_type = KINDS["literary"]
    name = F.replace(F.replace(F.lower(stem(F.col("original_path"))), F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" "))
    work = F.lit(None).cast("struct<title:string,author:string,document_type:string>")
    for key, (title, author, of) in KNOWN_WORKS.items():
        work = F.coalesce(work, F.when(F.contains(name, F.lit(key)), F.struct(F.lit(title).alias("title"), F.lit(author).alias("author"), F.lit(of).alias("document_type"))))
    known = documents.withColumn("_work", work)
    return known.select(
        "document_id", F.lit("es").alias("language"), F.lit(domain).alias("thematic_domain"), F.coalesce("_work.document_type", F.lit(document_type)).alias("document_type"),
        F.coalesce("_work.title", "title", stem(F.col("original_path"))).alias("title"), F.col("_work.author").alias("author"),
    )


def rebuilt(mapping: DataFrame, records: DataFrame, canonical: DataFrame, namespace: str, order: list[str]) -> DataFrame:
    """Documents put together again from a mapping (raw_filename, document_id, status, error), records and canonical texts.

    A file without a document gets an id of its name; records are found by the name of their file, the last by order; a document
    has its text (canonical: document_id, text) or was rejected before it had one. Rows: document_id, title, author, status,
    rejection_reason, word_count, character_count, paragraph_count, canonical_sha256.
    """
    last = records.where("local_path is not null").withColumn("raw_filename", F.element_at(F.split("local_path", "/"), -1)).select("raw_filename", *order, "title", "authors")
    last = last_of(last, "raw_filename", order).select("raw_filename", F.col("title").alias("_title"), "authors")
    named = F.coalesce(F.nullif("document_id", F.lit("")), T.uuid5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.concat(F.lit(namespace), "raw_filename")))
    joined = mapping.withColumn("document_id", named).join(last, "raw_filename", "left").join(canonical.select("document_id", "text"), "document_id", "left")
    failed = F.col("status") == "EXTRACTION_ERROR"
    text = F.when(~failed, F.col("text"))
    reason = F.when(failed, F.coalesce(F.nullif("error", F.lit("")), F.lit("extraction failed"))).when(text.isNull(), F.lit("no canonical text"))
    return joined.select(
        "document_id", F.coalesce(F.nullif("_title", F.lit("")), stem(F.col("raw_filename"))).alias("title"), F.nullif(F.array_join("authors", "; "), F.lit("")).alias("author"),
        F.when(text.isNull(), "REJECTED").otherwise("CANONICAL").alias("status"), reason.alias("rejection_reason"), T.word_count(text).alias("word_count"), F.length(text).cast("long").alias("character_count"),
        T.paragraph_count(text).alias("paragraph_count"), F.sha2(text, 256).alias("canonical_sha256"),
    )

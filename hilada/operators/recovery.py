"""Joins that rebuild lost links between files and documents, and the choice of page segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def by_hash(raw: DataFrame, extracted: DataFrame) -> DataFrame:
    """raw (file, text) with the document of extracted (document, text) of the same text; AMBIGUOUS where several have it."""
    right = extracted.select("document", F.sha2("text", 256).alias("sha256")).groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.min("document").alias("document"))
    left = raw.select("file", F.sha2("text", 256).alias("sha256"))
    status = F.when(F.col("n").isNull(), "UNMATCHED").when(F.col("n") > 1, "AMBIGUOUS").otherwise("MATCHED")
    return left.join(right, "sha256", "left").select("file", F.when(F.col("n") == 1, F.col("document")).alias("document"), status.alias("status"))


def by_likeness(raw: DataFrame, extracted: DataFrame, size: int = 5000) -> DataFrame:
    """The same by the first code points of the lower-cased text without line layout; only single candidates count."""
    key = lambda df: T.similarity_key(F.col("text"), size)
    right = extracted.select("document", F.sha2(key(extracted), 256).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("document").alias("document")).where("n = 1")
    left = raw.select("file", F.sha2(key(raw), 256).alias("k"))
    return left.join(right, "k", "left").select("file", "document", F.when(F.col("document").isNull(), "UNMATCHED").otherwise("RECOVERED").alias("status"))


def merged_mapping(primary: DataFrame, recovered: DataFrame) -> DataFrame:
    """The primary mapping, with recovered documents where it has none."""
    second = recovered.where("status = 'RECOVERED'").select("file", F.col("document").alias("second"))
    status = F.when(F.col("status") == "MATCHED", F.col("status")).when(F.col("second").isNotNull(), "RECOVERED").otherwise(F.col("status"))
    return primary.join(second, "file", "left").select("file", F.coalesce("document", "second").alias("document"), status.alias("status"))


def repeated_documents(mapping: DataFrame) -> DataFrame:
    """Documents that more than one file maps to."""
    return mapping.where("document is not null").groupBy("document").agg(F.count(F.lit(1)).alias("files")).where("files > 1")


def selected_segments(segments: DataFrame) -> DataFrame:
    """Of segments (dump, start_page, end_page) the chain that covers each dump's pages, each row with chosen and gap_before.

    Of segments with one start the longest counts; then in order each that begins after the last chosen one ends. A dump has few
    segments, so its list is folded in one row.
    """
    best = segments.groupBy("dump", "start_page").agg(F.max("end_page").alias("end_page"))
    listed = best.groupBy("dump").agg(F.sort_array(F.collect_list(F.struct("start_page", "end_page"))).alias("all"))
    empty = F.array().cast("array<struct<start_page:bigint,end_page:bigint>>")
    fold = F.aggregate("all", F.struct(F.lit(0).cast("long").alias("last"), empty.alias("chosen")), lambda acc, s: F.when(
        s["start_page"] > acc["last"], F.struct(s["end_page"].alias("last"), F.concat(acc["chosen"], F.array(s)).alias("chosen"))).otherwise(acc), lambda acc: acc["chosen"])
    chosen = listed.select("dump", F.posexplode(fold).alias("i", "s"), fold.alias("c"))
    before = F.when(F.col("i") == 0, F.lit(0)).otherwise(F.get("c", F.col("i") - 1)["end_page"])
    return chosen.select("dump", F.col("s.start_page").alias("start_page"), F.col("s.end_page").alias("end_page"), (F.col("s.start_page") - before - 1).alias("gap_before"))


def with_checksums(files: DataFrame, md5: DataFrame, sha1: DataFrame) -> DataFrame:
    """files with the sums of two lists (filename, sum); absent ones are null."""
    return files.join(md5.select("filename", F.col("sum").alias("md5")), "filename", "left").join(sha1.select("filename", F.col("sum").alias("sha1")), "filename", "left")

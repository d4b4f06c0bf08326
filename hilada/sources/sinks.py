"""Writing: tables by source, appended logs, CSV tables with fixed decimals, staged replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import corpus


def write_stage(df: DataFrame, path: str, stage: str) -> None:
    """The texts of a stage, in one directory for each source."""
    df.write.mode("overwrite").partitionBy("source_code").parquet(f"{path}/{stage}")


def append_audits(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_reports(df: DataFrame, path: str, key: str = "document_id", directories: int = 64) -> None:
    """A JSON report for each row, in directories by the hash of its key, so that one report is found without the others."""
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(directories)).alias("part"), F.to_json(F.struct("*")).alias("value"))
    rows.repartition("part").write.mode("overwrite").partitionBy("part").text(path)


def frequency_rows(ranked: DataFrame) -> DataFrame:
    """A ranked vocabulary as its CSV table has it."""
    return ranked.select(
        F.col("ranking").alias("Ranking"), F.col("word").alias("Palabra"), F.col("frequency").alias("Frecuencia"),
        F.format_string("%.10f", "relative_frequency").alias("FrecuenciaRelativa"), F.col("document_frequency").alias("FrecuenciaDocumental"),
    )


def version_rows(ranked: DataFrame) -> DataFrame:
    return ranked.select(
        F.col("ranking").alias("Ranking"), F.col("token").alias("Token"), F.col("word").alias("Palabra"), F.col("frequency").alias("Frecuencia"), F.format_string("%.10f", "relative_frequency").alias("FrecuenciaRelativa"),
        F.format_string("%.6f", F.col("relative_frequency") * 100).alias("Porcentaje"), F.col("cumulative_frequency").alias("FrecuenciaAcumulada"), F.format_string("%.6f", "coverage").alias("CoberturaAcumulada"),
    )


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """Sorted over all files: file names follow the order."""
    df.orderBy(*order).write.mode("overwrite").option("header", "true").csv(path)


def replace_checked(df: DataFrame, path: str, rows: int | None = None, keys: tuple[str, ...] = ()) -> str:
    """Writes beside the table, checks the number of rows and that keys are unique, and returns the path that then holds.

    Readers follow the returned path, so a failed check leaves them with the old table.
    """
    spark, staged = df.sparkSession, f"{path}/version={uuid.uuid4().hex}"
    df.write.parquet(staged)
    stored = spark.read.parquet(staged)
    if rows is not None and (n := stored.count()) != rows:
        raise ValueError(f"{n} rows instead of {rows}")
    if keys and stored.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"{', '.join(keys)} repeat")
    return staged


def upsert(spark, path: str, incoming: DataFrame, key: str, kept: tuple[str, ...] = ()) -> str:
    return replace_checked(corpus.upserted(spark.read.parquet(path), incoming, key, kept), path + "-next", keys=(key,))


def write_both_orders(vocabulary: DataFrame, path: str) -> None:
    """A vocabulary as two CSV tables, by frequency and by the alphabet, from one computation of its rows."""
    spark = vocabulary.sparkSession
    vocabulary.write.mode("overwrite").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    write_csv(rows, f"{path}/by_frequency", "ranking")
    write_csv(rows, f"{path}/alphabetical", "word")

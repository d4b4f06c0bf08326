"""Files as tables: text files with unknown encoding, XML dumps, JSON lines, CSV tables with byte order marks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

ENCODINGS = ("utf-8", "cp1252", "latin-1")


@F.pandas_udf(StringType())
def decoded(contents: pd.Series) -> pd.Series:
    """Bytes as text by the first encoding that fits, with LF line ends."""

    def one(data: bytes | None) -> str | None:
        if data is None:
            return None
        for e in ENCODINGS:
            try:
                return bytes(data).decode(e).replace("\r\n", "\n").replace("\r", "\n")
            except UnicodeDecodeError:
                continue
        return None

    return contents.map(one)


def text_files(spark: SparkSession, directory: str, extensions: tuple[str, ...] = (".txt",)) -> DataFrame:
    """Rows (path, length, sha256, text) of the files below a directory with one of the extensions, in any case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    suffix = F.lower(F.regexp_extract("path", "(\\.[^./]+)$", 1))
    files = files.where(suffix.isin(*(e.lower() for e in extensions)))
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), decoded("content").alias("text"))


def pdf_downloads(files: DataFrame, most: int = 50 * 1024 * 1024) -> DataFrame:
    """Adds accepted to binary files: not too large, and begun as PDF files are."""
    return files.withColumn("accepted", (F.col("length") <= most) & (F.substring("content", 1, 5) == F.lit(b"%PDF-")))


def xml_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page_id, ns, title, redirect, text) of a MediaWiki dump, plain or bz2."""
    schema = "title string, ns int, id long, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(schema).load(path)
    return pages.select(F.col("id").alias("page_id"), "ns", "title", F.col("redirect._title").alias("redirect"), F.col("revision.text._VALUE").alias("text"))


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of JSON lines in the order of reading; blank lines are none."""
    return spark.read.schema(schema).json(path).dropna("all")


def csv_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV table with a header, also after a byte order mark; a column that is missing is an error."""
    df = spark.read.option("header", "true").csv(path)
    df = df.toDF(*(c.lstrip("\ufeff") for c in df.columns))
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df.select(*columns)


def profile_files(paths: list[str]) -> dict[str, dict]:
    """Profiles of quality from YAML files, by their codes, in the form of operators.quality.PROFILES."""
    import yaml

    out = {}
    for path in paths:
        with open(path, encoding="utf-8") as file:
            read = yaml.safe_load(file) or {}
        rules = read.get("rules") or {}
        held = {
            "thresholds": read.get("thresholds") or {}, "disabled": rules.get("disabled_anomalies") or [], "severities": rules.get("severity_overrides") or {},
            "penalties": ((read.get("editorial_scoring") or {}).get("penalties") or {}) | (rules.get("penalty_overrides") or {}),
        }
        out[read["profile"]["code"]] = {k: v for k, v in held.items() if v}
    return out


#: Readers by extension; more can be registered.
READERS = {".txt": text_files}


def register(extension: str, reader) -> None:
    READERS["." + extension.lower().lstrip(".")] = reader


def read_files(spark: SparkSession, directory: str, extension: str) -> DataFrame:
    extension = "." + extension.lower().lstrip(".")
    if extension not in READERS:
        raise ValueError(f"nothing reads {extension}")
    return READERS[extension](spark, directory)

"""What the operators of this subpackage share: reading, newest states, tables in the shared folder, Arrow passes."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A line end followed by nothing but white space up to another line end parts two paragraphs.
PARAGRAPH = re.compile(r"\n\s*\n")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, enough: int = 32 * 1024 * 1024) -> DataFrame:
    """A small df over all cores where it has fewer files than those, as a file with one row group is read by one task.

    Inputs of `enough` bytes for each core are left as they are; their files aren't even listed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size >= enough * cores or len(df.inputFiles()) >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by spark.checkpoint.dir.

    Only where that is unset and all runs on this machine, as in tests, a temporary folder takes its place.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='hilada-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended
        pass


def written(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, with no lineage that a lost executor could break."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hilada-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(schema or df.schema).parquet(path)


def newest(df: DataFrame, key: str, at: str, *columns: str) -> DataFrame:
    """One row for each key: the one with the greatest `at`; ties go to the greatest remaining values, nulls come first.

    An aggregate of structs, so that each task combines its own rows before the shuffle.
    """
    held = F.max(F.struct(F.col(at), *(F.col(c) for c in columns if c != at))).alias("_held")
    return df.groupBy(key).agg(held).select(key, *(F.col(f"_held.{c}").alias(c) for c in columns))


def salted_join(df: DataFrame, small: DataFrame, key: str, salts: int = 8) -> DataFrame:
    """An inner join on a key of which some values are very frequent in df: each is parted over `salts` tasks, small is repeated."""
    parted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return parted.join(repeated, [key, "_salt"]).drop("_salt")


def arrow_pass(
    df: DataFrame, schema: str, start: Callable[[], Callable[[pa.RecordBatch], Iterator[dict[str, list]]]], flush: bool = False
) -> DataFrame:
    """mapInArrow with state for each task: start() gives the function for the batches.

    That function takes a record batch (None at the end if flush is set) and yields columns as lists, in the order of `schema`.
    """
    types = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)
        if flush:
            for columns in step(None):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    return df.mapInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(), "timestamp": pa.timestamp("us", "UTC"), "binary": pa.binary()}


def _arrow_schema(schema: str) -> pa.Schema:
    fields = []
    for part in re.split(r",\s*(?![^<]*>)", schema):
        name, kind = part.split(None, 1)
        inner = re.fullmatch(r"array<(\w+)>", kind)
        fields.append((name, pa.list_(_TYPES[inner[1]]) if inner else _TYPES[kind]))
    return pa.schema(fields)

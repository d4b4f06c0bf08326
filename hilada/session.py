"""Sessions for local work and reading of tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session with adaptive execution and UTC, as all operators expect; on a cluster the submitter configures it."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC")
    return builder.config("spark.ui.enabled", "false").config("spark.sql.adaptive.enabled", "true").config("spark.driver.memory", "8g").getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share, below spark.checkpoint.dir; a local one only where all runs on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='hilada-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where}/hilada-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, however often it is read, and safe if executors are lost."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    atexit.register(_removed, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _removed(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, factor: int = 1, enough: int = 32 * 1024 * 1024) -> DataFrame:
    """A small df over all cores where it has fewer files than those, as a file with one row group is read by one task.

    Costs a shuffle of the columns in use, so it belongs before work that is heavier than that. Inputs of `enough` bytes for each
    core are left as they are; their files aren't even listed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df if size >= enough * cores or len(df.inputFiles()) >= cores else df.repartition(cores * factor)

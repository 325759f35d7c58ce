"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from broadsheet.cluster import new_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage is cut,
    and a lost executor costs at most the tasks it was running. Parquet takes a fraction
    of the room of a checkpoint."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are done with: those of the tables
    just written. It does so anyway, but only when the driver collects its garbage. What the
    last job shuffled is held until another has run, so one that shuffles nothing is run first."""
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def file_system(path: str):
    """The file system of a path, for tasks, and the path in it, for Spark's spellings of local
    paths."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    there = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in there:
            name += "_"
        there.add(name.lower())
        out.append(name)
    return out


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

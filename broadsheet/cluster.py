"""Small helpers for running on a cluster: scratch space and broadcast checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

# Bytes up to which a table is broadcast, as ``row_bytes`` adds them up.
BROADCAST_BYTES = 100_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or one already set. Without
    either it is a folder in the warehouse, which the session shares in any case."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_broadsheet"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


# The folders made in the innermost scope that is open.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """A scope that owns what is written to the shared folder within it, and deletes it at its
    end, also after an error: checkpoints, and the folders of ``new_folder``. Results that are
    worked out lazily read them, so they must be written, or collected, within the scope."""
    folders: list[str] = []
    token = _scope.set(folders)
    try:
        yield
    finally:
        _scope.reset(token)
        for folder in folders:
            with suppress(Exception):  # what cannot be deleted must not hide another error
                delete_folder(spark, folder)


def _own(folder: str) -> str:
    folders = _scope.get()
    if folders is not None:
        folders.append(folder)
    return folder


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all in it, on whatever file system it is."""
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Rename a folder to a path where nothing is yet."""
    files, path = _file_system(spark, folder)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(path, target):
        raise FileExistsError(f"cannot move {folder} to {to}")


def write_mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    files, mark = _file_system(spark, path)
    files.create(mark).close()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return _own(f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, with its lineage cut."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    if _scope.get() is not None:
        file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            _own(file.get())
    return out


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: strings count with all their letters."""

    def size(name: str, kind: DataType) -> Column:
        if isinstance(kind, NumericType):
            return F.lit(16)
        if isinstance(kind, StringType):
            return F.coalesce(F.octet_length(name), F.lit(0)) + 32
        return 4 * F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) + 32

    total = F.lit(0)
    for f in df.schema.fields:
        total = total + size(f"`{f.name}`", f.dataType)
    return total.cast("long")


def is_small(df: DataFrame, most: int | None = None) -> bool:
    """Whether ``df`` may be broadcast, and has no more than ``most`` bytes. They are added up, so it
    should be a table that is kept: reading it then computes nothing that is not needed anyway."""
    most = BROADCAST_BYTES if most is None else min(most, BROADCAST_BYTES)
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= most


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """``df`` with a broadcast hint where its size has been checked, else as it is."""
    return F.broadcast(df) if small else df

"""Where intermediate results go: always the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a private one only where it is unset.

    Without the setting a cluster session is refused, because a machine-local
    folder would not be visible to the other executors.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="lastro-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, never reused folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage on reliable storage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends in here go with it, and not when the driver happens to collect its garbage.

    For steps that write what they work out: a frame that is run a second time shuffles again.
    """
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


# Small files of the driver, in whatever store Spark reads


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    store, place = _place(spark, folder)
    return [status.getPath().getName() for status in store.listStatus(place)] if store.exists(place) else []


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    store, place = _place(spark, folder)
    return store.getContentSummary(place).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _place(spark, path)
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all, and that no other writer has made before."""
    store, place = _place(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = store.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if store.exists(place) or not store.rename(draft, place):
        store.delete(draft, False)
        raise FileExistsError(f"{path} was written by another writer")


def delete(spark: SparkSession, path: str) -> None:
    store, place = _place(spark, path)
    store.delete(place, True)


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Name, length and time of change of what a folder holds directly."""
    store, place = _place(spark, folder)
    held = ((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in store.listStatus(place))
    return tuple(sorted(held))

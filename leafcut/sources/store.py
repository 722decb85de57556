"""Folders that several runs share: exclusive claims, and small tables of which every change is a version of its own.

A version is written beside the older ones first and then published under its number by one atomic step, which fails if another
run has taken that number meanwhile. Readers look a version up once and keep to its files, which never change. Whatever ends a
run before that step leaves files that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"


def located(spark: SparkSession, path: str):
    """A path and its file system, as Spark's session sees them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = located(spark, path)
    return fs.exists(at)


def is_file(spark: SparkSession, path: str) -> bool:
    at, fs = located(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isFile()


def delete(spark: SparkSession, path: str) -> None:
    at, fs = located(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a path to a name that is free."""
    at, fs = located(spark, path)
    if not fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} can't be moved to {to}")


def _local(spark: SparkSession, at, fs):
    """The path for the operating system, where it is a local one: Hadoop's local file system overwrites without a word."""
    if fs.makeQualified(at).toUri().getScheme() != "file":
        return None
    return spark._jvm.java.nio.file.Paths.get(fs.makeQualified(at).toUri())


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a small file with all its text at once; false if there is one of that name. Of several that try, one succeeds."""
    at, fs = located(spark, path)
    fs.mkdirs(at.getParent())
    beside, _ = located(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(text.encode())
    out.close()
    try:
        if (local := _local(spark, at, fs)) is None:
            return not fs.exists(at) and fs.rename(beside, at)
        spark._jvm.java.nio.file.Files.createLink(local, _local(spark, beside, fs))
        return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.nio.file.FileAlreadyExistsException":
            raise
        return False
    finally:
        if fs.exists(beside):
            fs.delete(beside, False)


def claim(spark: SparkSession, root: str, name: str) -> str:
    """The folder root/name_vN of the smallest N that nobody has claimed, now claimed."""
    n = 1
    while True:
        folder = f"{root.rstrip('/')}/{name}_v{n}"
        # A folder without a claim is another program's.
        if not exists(spark, folder) and publish(spark, f"{folder}/_claim", folder):
            return folder
        n += 1


def latest(spark: SparkSession, path: str) -> int:
    """The newest version's number; 0 if there is none."""
    at, fs = located(spark, f"{path}/{VERSIONS}")
    if not fs.exists(at):
        return 0
    return max((int(x.getPath().getName()) for x in fs.listStatus(at) if x.getPath().getName().isdigit()), default=0)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A version's rows, the newest one's if none is given, and from then on just these; null if there is none."""
    n = latest(spark, path) if version is None else version
    if not n:
        return None
    folder = spark.read.option("wholetext", True).text(f"{path}/{VERSIONS}/{n}").first()[0]
    return spark.read.parquet(f"{path}/{folder}")


def update(spark: SparkSession, path: str, change: Callable[[DataFrame | None, int], DataFrame], tries: int = 10) -> int:
    """Publishes change(the newest rows, the number to come) as the next version and returns its number. If another run was first, the change is made again, to that run's rows."""
    for _ in range(tries):
        n = latest(spark, path) + 1
        folder = f"v{n}-{uuid.uuid4().hex}"
        change(read(spark, path, n - 1), n).write.parquet(f"{path}/{folder}")
        if publish(spark, f"{path}/{VERSIONS}/{n}", folder):
            return n
        delete(spark, f"{path}/{folder}")
    raise RuntimeError(f"{path} was changed by others {tries} times meanwhile")

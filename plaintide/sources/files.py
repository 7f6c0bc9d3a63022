"""The few file-system calls Spark has no DataFrame form for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _resolve(spark, path)
    return files.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _resolve(spark, path)
    files.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under `path`, sorted; none if it does not exist."""
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target))


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file and its folder; False if the file was there."""
    files, target = _resolve(spark, path)
    files.mkdirs(target.getParent())
    return files.createNewFile(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file whole."""
    files, target = _resolve(spark, path)
    out = files.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file was written, in milliseconds of the file system's clock; None if it is gone."""
    files, target = _resolve(spark, path)
    return files.getFileStatus(target).getModificationTime() if files.exists(target) else None


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target

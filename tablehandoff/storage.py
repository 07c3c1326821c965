"""Renames and deletes on whatever file system a path lives on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    file_system(spark, path).mkdirs(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(_path(spark, path), True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the regular files directly in a folder, sorted."""
    if not exists(spark, folder):
        return []
    entries = file_system(spark, folder).listStatus(_path(spark, folder))
    return sorted(e.getPath().getName() for e in entries if e.isFile())


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in a folder, sorted."""
    if not exists(spark, folder):
        return []
    entries = file_system(spark, folder).listStatus(_path(spark, folder))
    return sorted(e.getPath().getName() for e in entries if e.isDirectory())


def matching_files(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the regular files in a folder that start with ``prefix``, sorted."""
    escaped = re.sub(r"([*?\[\]{}\\])", r"\\\1", prefix)
    pattern = _path(spark, f"{folder.rstrip('/')}/{escaped}*")
    entries = file_system(spark, folder).globStatus(pattern) or []
    return sorted(e.getPath().getName() for e in entries if e.isFile())


def file_size(spark: SparkSession, path: str) -> int | None:
    """Bytes of a regular file; null if there is none."""
    if not exists(spark, path):
        return None
    status = file_system(spark, path).getFileStatus(_path(spark, path))
    return status.getLen() if status.isFile() else None


def partition_folder(path: str, column: str, value: str) -> str:
    """The folder of a partition, its value escaped as Spark's writers do."""
    special = r"[\x00-\x1f\x7f\"#%'*/:=?\\{}\[\]^]"
    escaped = re.sub(special, lambda m: f"%{ord(m[0]):02X}", value)
    return f"{path.rstrip('/')}/{column}={escaped}"


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename that replaces an existing target."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    qualified = file_system(spark, target).makeQualified(_path(spark, target))
    context = hadoop.FileContext.getFileContext(
        qualified.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(
        file_system(spark, source).makeQualified(_path(spark, source)), qualified, options
    )


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename in one step; an error if the target exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    qualified = file_system(spark, target).makeQualified(_path(spark, target))
    context = hadoop.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(file_system(spark, source).makeQualified(_path(spark, source)), qualified, options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; an error if it exists."""
    stream = file_system(spark, path).create(_path(spark, path), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        size = file_system(spark, path).getFileStatus(_path(spark, path)).getLen()
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(size))).decode()
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file without its line break; null for an empty file."""
    java = spark._jvm.java
    stream = file_system(spark, path).open(_path(spark, path))
    reader = java.io.BufferedReader(
        java.io.InputStreamReader(stream, java.nio.charset.StandardCharsets.UTF_8)
    )
    try:
        return reader.readLine()
    finally:
        reader.close()

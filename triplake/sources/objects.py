"""Delivered and landed objects by name, on any Hadoop file system."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class BronzeObject(NamedTuple):
    name: str
    path: str
    uri: str  # encoded, the way Spark reports file paths
    folder: str  # URI of the folder that holds it
    is_folder: bool
    modified: int
    landed: bool = False  # in a landing's run, and not under its own name


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and the file system that holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def glob_objects(spark: SparkSession, pattern: str) -> list[BronzeObject]:
    """Objects that fit ``pattern``, in name order.

    Lists names only: one entry per month, however many part files it has.
    """
    path, fs = file_system(spark, pattern)
    found = []
    for status in fs.globStatus(path) or []:
        p = status.getPath()
        folder = p.getParent().toUri().toString()
        uri, modified = p.toUri().toString(), status.getModificationTime()
        found.append(BronzeObject(p.getName(), p.toString(), uri, folder, status.isDirectory(), modified))
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    at, fs = file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _written(fs, at, text: str) -> None:
    # Object stores that know conditional writes refuse a second one by themselves.
    builder = fs.createFile(at).overwrite(False).recursive()
    stream = builder.opt("fs.option.create.conditional.overwrite", True).build()
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file if there is none; False where another writer was first."""
    at, fs = file_system(spark, path)
    local = fs.getScheme() == "file"
    try:
        if not local:
            _written(fs, at, text)
            return True
        # A local file system creates files without asking; a link to a finished file is
        # made only once.
        made, _ = file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
        _written(fs, made, text)
        nio = spark._jvm.java.nio.file
        paths = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (at, made)]
        try:
            nio.Files.createLink(*paths)
        finally:
            fs.delete(made, False)
        return True
    except Py4JJavaError as error:
        kind = error.java_exception.getClass().getSimpleName()
        if kind == "FileAlreadyExistsException":
            return False
        if not (local and kind in ("UnsupportedOperationException", "FileSystemException")):
            raise
    # A mount without links: as on other stores, by a create that does not overwrite.
    try:
        _written(fs, at, text)
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise

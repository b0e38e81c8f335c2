"""Whole-folder steps on the cluster's file system: a table is written beside its place and then put there."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def beside(path: str, purpose: str = "new") -> str:
    """A new path in the folder of `path`, hidden from readers of that folder."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{purpose}-{uuid.uuid4().hex}"


def swap(spark: SparkSession, new: str | None, path: str) -> None:
    """Put the folder `new` in the place of `path`; without `new`, only take `path` away.

    Two renames: if the second fails, the old folder is put back. It is deleted only when the new one is in place.
    """
    fs, target = _at(spark, path)
    old = None
    if fs.exists(target):
        _, old = _at(spark, beside(path, "old"))
        if not fs.rename(target, old):
            raise OSError(f"cannot move {path} aside")
    if new is not None:
        _, source = _at(spark, new)
        fs.mkdirs(target.getParent())
        done = False
        try:
            done = fs.rename(source, target)
        finally:
            if not done and old is not None:
                fs.rename(old, target)
        if not done:
            raise OSError(f"cannot move {new} to {path}")
    if old is not None:
        fs.delete(old, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None without the file."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """A small file, there as a whole or not at all: it is written beside its place and renamed. Without `replace`, an existing one is an error."""
    fs, where = _at(spark, path)
    _, new = _at(spark, beside(path))
    fs.mkdirs(where.getParent())
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.exists(where):
            if not replace:
                raise FileExistsError(path)
            fs.delete(where, False)
        if not fs.rename(new, where):
            raise FileExistsError(path)
    finally:
        fs.delete(new, False)

"""Small files of the driver's own, on whatever file system Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if it isn't there."""
    fs, p = at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's text; None if it isn't there."""
    fs, p = at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; False if there is one already. Needs a file system
    whose rename is atomic."""
    folder, _, name = path.rpartition("/")
    fs, made = at(spark, f"{folder}/.{name}.making")
    out = fs.create(made, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, final = at(spark, path)
    return not fs.exists(final) and fs.rename(made, final)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = at(spark, path)
    return bool(fs.delete(p, True))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = at(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = at(spark, path)
    if not fs.rename(p, at(spark, to)[1]):
        raise RuntimeError(f"{path} cannot become {to}")

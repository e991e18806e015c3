"""Output directories of finished write jobs. Spark creates ``_SUCCESS`` last,
so a directory that holds it is complete; the library's writers force it on
whatever the cluster's default."""

from __future__ import annotations

from pyspark.sql import SparkSession

MARK_SUCCESS = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def finished(spark: SparkSession, pattern: str) -> list[str]:
    """Finished directories that match a glob, in name order (one listing)."""
    fs, p = _path(spark, f"{pattern}/_SUCCESS")
    return sorted(st.getPath().getParent().toString() for st in (fs.globStatus(p) or []))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in name order (one listing)."""
    fs, p = _path(spark, pattern)
    return sorted(st.getPath().toString() for st in (fs.globStatus(p) or []))


def write_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small text file, replaced if it exists."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray("".join(f"{x}\n" for x in lines).encode()))
    finally:
        out.close()


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """The lines of a small text file; none if it doesn't exist."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode().splitlines()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)

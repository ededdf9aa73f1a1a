"""The few file-system calls Spark has no DataFrame form for."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_MOVES_AT_ONCE = 16


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Folders and files that fit a glob pattern; none is an empty list."""
    fs, p = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(p) or []]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def folders_below(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Names, relative to ``root``, of the partition folders ``depth`` levels down ('' for none)."""
    if depth == 0:
        return [""]
    fs, p = _path(spark, root + "/*=*" * depth)
    start = len(fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)).toString()) + 1
    return [status.getPath().toString()[start:] for status in fs.globStatus(p) or []]


def replace(spark: SparkSession, source: str, target: str, folders: list[str]) -> None:
    """Put each folder of ``source`` in the place of its namesake under ``target``.

    A folder no longer in ``source`` was moved by an earlier attempt.
    """
    fs, _ = _path(spark, source)
    as_path = spark._jvm.org.apache.hadoop.fs.Path

    def move(folder: str) -> None:
        src, dst = as_path(f"{source}/{folder}".rstrip("/")), as_path(f"{target}/{folder}".rstrip("/"))
        if not fs.exists(src):
            return
        if not fs.delete(dst, True):
            fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not move {source}/{folder} to {target}")

    with ThreadPoolExecutor(_MOVES_AT_ONCE) as pool:
        list(pool.map(move, folders))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is either there as a whole or not at all."""
    fs, p = _path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(draft, p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def partition_folder(spark: SparkSession, columns, values) -> str:
    """``year=2024/month=01`` with Spark's own escaping of awkward values."""
    naming = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(naming.getPartitionPathString(c, v) for c, v in zip(columns, values))

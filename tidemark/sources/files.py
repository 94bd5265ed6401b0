"""Small files and folders, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``."""
    return _system(spark, path).exists(_path(spark, path))


def discard(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path``, if anything is."""
    _system(spark, path).delete(_path(spark, path), True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, ascending; none if there is no such path. One
    listing, which opens no file."""
    if not path_exists(spark, path):
        return []
    found = _system(spark, path).listStatus(_path(spark, path))
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target``, of which only the parent may exist."""
    system = _system(spark, target)
    system.mkdirs(_path(spark, target).getParent())
    if not system.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source!r} to {target!r}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    if not path_exists(spark, path):
        return None
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name first, so that it is never there in part."""
    system, fresh = _system(spark, path), f"{path}.new"
    stream = system.create(_path(spark, fresh), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.delete(_path(spark, path), False)
    move(spark, fresh, path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that goes when the application ends."""
    system = _system(spark, path)
    system.mkdirs(_path(spark, path))
    system.deleteOnExit(_path(spark, path))

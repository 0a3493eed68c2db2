"""Small metadata files and folder listings, through the Hadoop file system of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files and folders right below a path; none if it is missing.

    The listing crosses from the JVM as one text, a path a line, whatever its length.
    """
    files, target = _file_system(spark, path), _path(spark, path)
    if not files.exists(target):
        return []
    entries = files.listStatus(target)
    if not len(entries):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(entries)
    text = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(paths).mkString("\n")
    names = [line.rsplit("/", 1)[-1] for line in text.split("\n")]
    return sorted(n for n in names if not _hidden(n))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of all files and folders that a glob pattern names, in order; they cross from the JVM as one text."""
    entries = _file_system(spark, pattern).globStatus(_path(spark, pattern))
    if entries is None or not len(entries):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(entries)
    return sorted(spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(paths).mkString("\n").split("\n"))


def is_folder(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def plain(spark: SparkSession, path: str) -> str:
    """The path without scheme and host, as two spellings of one folder share it."""
    return _path(spark, path).toUri().getPath().rstrip("/")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders right below a path, for short listings."""
    return [n for n in children(spark, path) if is_folder(spark, f"{path}/{n}")]


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative paths of the ``column=value`` folders ``depth`` levels below; the path itself (``""``) for depth 0."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{folder}/{name}".lstrip("/")
            for folder in found
            for name in children(spark, f"{path}/{folder}".rstrip("/"))
            if "=" in name
        ]
    return found


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    return _file_system(spark, path).getContentSummary(_path(spark, path)).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small file at once: write it under a hidden name, then rename; fails if it exists."""
    folder, _, name = path.rpartition("/")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    hidden = f"{folder}/.{name}.{spark._jvm.java.util.UUID.randomUUID().toString()}"
    stream = _file_system(spark, hidden).create(_path(spark, hidden), False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = getattr(rename, "NONE")
    context.rename(_path(spark, hidden), _path(spark, path), options)


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)

"""What is in a folder, asked of the file system that holds it (any that Spark can read).

Missing paths are answers here; every other failure rises."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a glob pattern."""
    fs, p = _open(spark, pattern)
    return bool(fs.globStatus(p))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's file sources name it."""
    fs, p = _open(spark, path)
    return fs.makeQualified(p).toString()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` has ended (its job leaves a marker)."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a file, or a folder with anything but markers and hidden files."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isFile():
        return True
    return any(not n.startswith(("_", ".")) for n in children(spark, path))


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where there is one already."""
    fs, p = _open(spark, path)
    return fs.createNewFile(p)


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written."""
    fs, p = _open(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def delete_file(spark: SparkSession, uri: str) -> None:
    """Delete a file named by its URI, as file metadata columns name it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is not there is fine."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files in a folder and its folders, below it; none where it is not there."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    found, root = fs.listFiles(p, True), len(fs.makeQualified(p).toString()) + 1
    out = []
    while found.hasNext():
        out.append(found.next().getPath().toString()[root:])
    return out


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, making the folder it goes to; one already moved is fine."""
    fs, p = _open(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not fs.exists(p) and fs.exists(to):
        return
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} cannot be moved to {target}")


def plain_path(spark: SparkSession, path: str) -> str:
    """The absolute path without scheme and authority, not encoded."""
    fs, p = _open(spark, path)
    return fs.makeQualified(p).toUri().getPath()


def escaped(path: str) -> str:
    """A path as a reader takes it, without glob patterns."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name, then renamed."""
    fs, p = _open(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):
        raise OSError(f"{path} cannot be written")


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()

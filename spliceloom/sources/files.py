"""Single files on any file system: by Hadoop's on the driver, by pyarrow's or plain files where Python code reads and writes sequences."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def local(path: str) -> str | None:
    """The path as a local one, None if it lies in another file system."""
    u = urlparse(path)
    return path if u.scheme == "" else unquote(u.path) if u.scheme == "file" else None


def system(path: str):
    """(pyarrow's file system, path in it): what Python code on executors uses."""
    from pyarrow import fs

    at = local(path)
    return fs.FileSystem.from_uri(path) if at is None else (fs.LocalFileSystem(), at)


def open_bytes(path: str):
    """A binary file that can be read from any byte on."""
    if (at := local(path)) is not None:
        return open(at, "rb")
    import io

    there, where = system(path)
    return io.BufferedReader(there.open_input_file(where), 1 << 20)


def exists(path: str) -> bool:
    from pyarrow import fs

    there, where = system(path)
    return there.get_file_info(where).type != fs.FileType.NotFound


def parts(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files in a folder by name, without hidden ones."""
    from pyarrow import fs

    there, where = system(path)
    info = there.get_file_info(where)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type != fs.FileType.Directory:
        return [(path, info.size)]
    found = [x for x in there.get_file_info(fs.FileSelector(where)) if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))]
    return sorted((f"{path.rstrip('/')}/{x.base_name}", x.size) for x in found)


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def listed(spark: SparkSession, folder: str) -> list[tuple[str, str, bool]]:
    """(name, path, is a folder) of what a folder holds, by name."""
    system, p = _at(spark, folder)
    return sorted((s.getPath().getName(), s.getPath().toString(), s.isDirectory()) for s in system.listStatus(p))


def make_folder(spark: SparkSession, path: str) -> None:
    system, p = _at(spark, path)
    if system.exists(p) and not system.getFileStatus(p).isDirectory():
        raise ValueError(f"the output is a file: {path}")
    system.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    system, p = _at(spark, path)
    system.delete(p, True)


def put_together(spark: SparkSession, head: str, sources: list[str], target: str) -> None:
    """A text and the bytes of files, one after another, in place of what stands at the target."""
    there, p = _at(spark, f"{target}.new")
    out = there.create(p, True)
    try:
        out.write(bytearray(head.encode()))
        for source in sources:
            system_, q = _at(spark, source)
            part = system_.open(q)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            finally:
                part.close()
    finally:
        out.close()
    move(spark, f"{target}.new", target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file over what stands at the target."""
    delete(spark, target)
    system, p = _at(spark, source)
    system.mkdirs(_at(spark, target)[1].getParent())
    if not system.rename(p, _at(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    (a, p), (b, q) = _at(spark, source), _at(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, False, True, spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, p = _at(spark, path)
    out = system.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()

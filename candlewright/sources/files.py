"""Paths through Spark's own file system layer: any URI the session can read."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewright.functions import periods as P


def _hadoop(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _hadoop(spark, path)
    return system.exists(location)


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    length: int


def listing(spark: SparkSession, path: str) -> list[Entry]:
    """Direct children of a folder; nothing when it does not exist. File names only, no data."""
    system, location = _hadoop(spark, path)
    if not system.exists(location):
        return []
    found = [Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen()) for s in system.listStatus(location)]
    return sorted(found, key=lambda e: e.name)


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist, in their order; one listing for each folder they lie in."""
    folders: dict[str, set[str]] = {}
    found = []
    for path in paths:
        folder, _, name = path.rstrip("/").rpartition("/")
        if folder not in folders:
            folders[folder] = {e.name for e in listing(spark, folder or ("/" if path.startswith("/") else "."))}
        if name in folders[folder]:
            found.append(path)
    return found


def bare(path: str) -> str:
    """A path without scheme and leading slashes."""
    return re.sub(r"^[A-Za-z0-9+.-]+:/*|^/+", "", path)


def first_line(spark: SparkSession, path: str) -> str:
    """Header of one text file. Reads a single line, not the file."""
    system, location = _hadoop(spark, path)
    stream = system.open(location)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def write_line(spark: SparkSession, path: str, text: str) -> None:
    """A small file of one line."""
    system, location = _hadoop(spark, path)
    stream = system.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark names it in file metadata, without scheme and leading slashes; only a relative one is looked up."""
    if not re.match(r"[A-Za-z0-9+.-]+:|/", path):
        system, location = _hadoop(spark, path)
        path = system.makeQualified(location).toUri().toString()
    return bare(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job of this package has made."""
    system, location = _hadoop(spark, path)
    system.delete(location, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    system, location = _hadoop(spark, source)
    destination = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(destination.getParent())
    if system.exists(destination):
        raise FileExistsError(target)
    if not system.rename(location, destination):
        raise OSError(f"could not move {source} to {target}")


def has_extension(path: str, extension: str) -> bool:
    """A usable file path ends with the extension and names a file."""
    name = path.rsplit("/", 1)[-1]
    return name.lower().endswith(f".{extension.lower()}") and len(name) > len(extension) + 1


def period_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Bar files of a folder with period, kind, bounds and size, oldest and longest span first.

    The ``binaryFile`` source lists files on the cluster; its content column is never read. Files in
    subfolders (days already merged, for example) do not belong to the folder.
    """
    columns = ["file_path_str", "file_name_str", "period_str", "period_kind_str", "first_date", "last_date", "length"]
    if not exists(spark, folder):
        empty = spark.range(0)
        types = {"first_date": "date", "last_date": "date", "length": "bigint"}
        return empty.select(*[F.lit(None).cast(types.get(c, "string")).alias(c) for c in columns])
    own = _hadoop(spark, folder)[1].toUri().getPath().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{P.FILE_PREFIX}_*.csv").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    files = found.select("path", "length").where(F.col("path").endswith(F.concat(F.lit(f"{own}/"), name)))
    named = files.select(F.col("path").alias("file_path_str"), name.alias("file_name_str"), "length").withColumn(
        "period_str", P.period_of_file(F.col("file_name_str"))
    )
    period = F.col("period_str")
    catalog = (
        named.where(period.isNotNull())
        .withColumn("period_kind_str", P.period_kind(period))
        .withColumn("first_date", P.first_date(period))
        .withColumn("last_date", P.last_date(period))
    )
    return catalog.select(*columns).orderBy("first_date", F.length("period_str"))

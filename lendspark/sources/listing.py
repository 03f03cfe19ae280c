"""What lies under a path, from the file system alone: no file is opened."""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.sources.lake import DATE_PARTS


def _of(spark: SparkSession, path: str):
    """Hadoop's file system and path object, for any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _of(spark, path)
    return fs.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path, sorted; none if it does not exist."""
    fs, where = _of(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def _numbered(names: list[str], part: str) -> list[tuple[int, str]]:
    found = ((re.fullmatch(rf"{part}=(\d+)", n), n) for n in names)
    return sorted((int(m.group(1)), n) for m, n in found if m)


def date_folders(
    spark: SparkSession, path: str, newest_only: bool = False
) -> list[tuple[tuple[int, int, int], str]]:
    """((year, month, day), folder) of the partitions, newest first, compared as numbers.

    Walks year, month and day folders, of which there are as many as days. With
    ``newest_only`` it lists the newest branch that holds a day.
    """
    found: list[tuple[tuple[int, int, int], str]] = []

    def walk(folder: str, values: tuple[int, ...]) -> None:
        if len(values) == len(DATE_PARTS):
            found.append((values, folder))
            return
        below = _numbered(names_in(spark, folder), DATE_PARTS[len(values)])
        # A number may have several spellings, such as 1 and 01.
        for value, same in groupby(reversed(below), key=lambda n: n[0]):
            for _, name in same:
                walk(f"{folder}/{name}", (*values, value))
            if newest_only and found:
                return

    walk(path.rstrip("/"), ())
    return found


def partitions(spark: SparkSession, path: str) -> DataFrame:
    """Partitions of a table by their folders, newest first."""
    ddl = ", ".join(f"{c} INT" for c in DATE_PARTS)
    days = dict.fromkeys(values for values, _ in date_folders(spark, path))
    return spark.createDataFrame(list(days), ddl)


def files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file below a path: path, size, time of change. Listed by Spark's own tasks.

    The files' content is not read, so empty and damaged ones are listed like others.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return listed.load(path).select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified")
    )


def newest(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Rows of the newest day's folder; no other folder is listed or read."""
    found = date_folders(spark, path, newest_only=True)
    if not found:
        raise ValueError(f"table has no partitions: {path}")
    root = path.rstrip("/")
    folders = [folder for values, folder in found if values == found[0][0]]
    reader = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet")
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    return reader.parquet(*folders)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder with all its files; the folders above the target are made."""
    fs, where = _of(spark, target)
    fs.mkdirs(where.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), where):
        raise OSError(f"cannot move {source} to {target}")


def move_files(spark: SparkSession, source: str, target: str, pattern: str, suffix: str) -> None:
    """Move files to the same folders under another root, with another ending of their names."""
    fs, root = _of(spark, source)
    base = fs.makeQualified(root).toString()
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    for row in files(spark, source, pattern).select("file_path").collect():
        inner = row.file_path[row.file_path.index(path_of(base).toUri().getPath()) :]
        relative = inner[len(path_of(base).toUri().getPath()) :].lstrip("/")
        fs.rename(path_of(row.file_path), path_of(f"{target}/{relative.rpartition('.')[0]}{suffix}"))


def _plain_path(path: Column) -> Column:
    """A file's path as listings write it: one slash after the scheme, nothing encoded."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([a-z0-9]+):/+(?=[^/])", "$1:/")


def _rows_by_file(spark: SparkSession, path: str, schema, checked: bool) -> DataFrame:
    """Rows per file; ``checked`` reads every column, otherwise footers alone tell them."""
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    rows = reader.option("ignoreCorruptFiles", True).parquet(path)
    counts = [F.count(F.lit(1)).alias("rows")]
    if checked:
        counts.append(F.max(F.xxhash64(*rows.columns)).alias("read"))
    return rows.groupBy(_plain_path(F.col("_metadata.file_path")).alias("file_path")).agg(*counts)


def inventory(spark: SparkSession, path: str, schema) -> DataFrame:
    """One row per data file, also without rows: size, rows by its footer, and the date of its folder.

    A file whose footer cannot be read has null rows or none, see ``rejected``.
    """
    listed = files(spark, path).withColumn("file_path", _plain_path(F.col("file_path")))
    counted = _rows_by_file(spark, path, schema, checked=False)
    part = {c: F.regexp_extract("file_path", rf"/{c}=(\d+)/", 1).try_cast("int") for c in DATE_PARTS}
    return listed.join(counted, "file_path", "left").select(
        "file_path",
        "file_size",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        *(c.alias(n) for n, c in part.items()),
        F.format_string("year=%d/month=%d/day=%d", *part.values()).alias("partition_path"),
    )


def _fault(spark: SparkSession, schema, paths: list[str]) -> str | None:
    """Why a strict read of the files' footers fails; None if it does not."""
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", False)
    try:
        reader.parquet(*paths).count()
    except Exception as error:  # whatever the reader says is the answer
        text = str(error)
        for known in (
            "is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "CANNOT_READ_FOOTER", "corrupted footer",
            "Could not read footer",
        ):
            if known in text:
                return "not a Parquet file" if "Parquet file" in text else "unreadable footer"
        return text.strip().splitlines()[0][:300]
    return None


def rejected(spark: SparkSession, path: str, schema) -> DataFrame:
    """Files that a scan which skips corrupt files leaves out, whole or in part, and why.

    Files of which no row is read are either empty or damaged. They are read strictly in
    halves, ever smaller around those that fail, so that few damaged files among many take
    few reads. A file with fewer readable rows than its footer says is damaged further in.
    """
    counted = _rows_by_file(spark, path, schema, checked=False)
    listed = files(spark, path).select(F.col("file_path").alias("listed"), _plain_path(F.col("file_path")).alias("file_path"))
    suspects = [r.listed for r in listed.join(counted, "file_path", "left_anti").orderBy("listed").collect()]
    found: list[tuple[str, str]] = []

    def halve(paths: list[str]) -> None:
        if not paths or (fault := _fault(spark, schema, paths)) is None:
            return
        if len(paths) == 1:
            found.append((paths[0], fault))
            return
        halve(paths[: len(paths) // 2])
        halve(paths[len(paths) // 2 :])

    halve(suspects)
    whole = spark.createDataFrame(found, "file_path STRING, reason STRING").select(
        _plain_path(F.col("file_path")).alias("file_path"), "reason", F.lit(0).cast("long").alias("rows_read")
    )
    # The hash is never null; asking for it keeps the columns in the scan.
    read = _rows_by_file(spark, path, schema, checked=True).select(
        "file_path", F.when(F.col("read").isNotNull(), F.col("rows")).alias("rows_read")
    )
    partly = counted.join(read, "file_path", "left").withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))
    partly = partly.where(F.col("rows_read") < F.col("rows")).select(
        "file_path", F.concat(F.lit("unreadable after row "), F.col("rows_read")).alias("reason"), "rows_read"
    )
    return whole.unionByName(partly)

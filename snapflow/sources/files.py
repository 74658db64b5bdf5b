"""File discovery (S1, A3, X25): the newest file of a pattern, from file metadata only.

``binaryFile`` lists files as rows; selecting only ``path``/``modificationTime`` prunes the
``content`` column, so no file body is read.  The pick is an aggregate (``max_by``), so the
listing is never collected; only the single answer reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapflow.functions.text import base_name, strip_extension


def list_files(spark: SparkSession, folder: str, pattern: str = "*",
               recursive: bool = True) -> DataFrame:
    """``path, file_name, base, modificationTime, length`` for files matching ``pattern``."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", str(recursive).lower()).load(folder)
          .select("path", "modificationTime", "length"))
    return df.select("path", base_name("path").alias("file_name"),
                     strip_extension(base_name("path")).alias("base"),
                     F.element_at(F.split("path", "/"), -2).alias("parent"),
                     "modificationTime", "length")


def newest(files: DataFrame, by: str = "mtime") -> DataFrame:
    """A3: one row, the newest file.  ``by='mtime'`` orders by modification time (creation time
    in the reference), ``by='name'`` by file name (labels such as ``_202401``), ``by='path'`` by
    the whole path (dated folders); ties break on the other fields so the answer is
    deterministic."""
    order = {"mtime": F.struct("modificationTime", "path"),
             "name": F.struct("file_name", "modificationTime", "path"),
             "path": F.struct("path", "modificationTime")}[by]
    return files.agg(F.max_by(F.struct("path", "file_name", "base", "parent",
                                       "modificationTime"), order).alias("f")).select("f.*")


def latest_file(spark: SparkSession, folder: str, pattern: str, by: str = "mtime"):
    """``(path, file_name)`` of the newest matching file, or ``None``."""
    r = newest(list_files(spark, folder, pattern), by).first()
    if r is None or r["path"] is None:
        return None
    return r["path"], r["file_name"]


def latest_feed(spark: SparkSession, folder: str, pattern: str):
    """S1 for feeds that are either one file or a folder of part files (what a distributed
    writer lands): the entries directly under ``folder`` whose name matches ``pattern`` are
    the feeds; a feed's time is the newest modification time of its files.  Metadata only, one
    aggregate; returns ``(path, name)`` of the newest feed or ``None``."""
    import fnmatch
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    files = list_files(spark, folder, "*", recursive=True)
    # the part of the path below the listed folder, whatever its parents are called
    at = F.locate(top, F.col("path"))
    below = F.substring(F.col("path"), at + F.lit(len(top)), F.lit(2 ** 31 - 1))
    entry = F.substring_index(below, "/", 1)
    feeds = (files.where(at > 0).select(entry.alias("feed"), at.alias("at"), "path", "modificationTime")
             .where(F.col("feed").rlike(fnmatch.translate(pattern)))
             .select("feed", F.concat(F.substring(F.col("path"), F.lit(1), F.col("at") + F.lit(len(top) - 1)), "feed")
                     .alias("feed_path"), "modificationTime")
             .groupBy("feed", "feed_path").agg(F.max("modificationTime").alias("t")))
    r = feeds.agg(F.max_by(F.struct("feed_path", "feed"), F.struct("t", "feed")).alias("f")) \
        .select("f.*").first()
    if r is None or r["feed_path"] is None:
        return None
    return r["feed_path"], r["feed"]

"""Archive expansion (S5, J3): expand zip archives that have not been expanded yet.

Archives are read with ``binaryFile`` (one archive per row, so archives are spread over tasks), from
any store that Spark reads.  An archive near ``binaryFile``'s 2 GB row limit is read by the data source
``zip_members`` instead: one partition a member, whose task reads the archive's directory and then the
member's bytes as it decodes them, so neither is ever held whole.  Tasks reach the file through
``pyarrow.fs`` (mounted folders, HDFS, S3, GCS).  Already-expanded archives are skipped with a
``left_anti`` join on the base name against the text files present.  Each member is emitted as lines,
so the output is an ordinary line table that Spark can write as text.
"""

from __future__ import annotations

import fnmatch
import io
import itertools
from urllib.parse import quote
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from snapflow.functions.text import base_name, strip_extension
from snapflow.sources.files import latest_file

LINES = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])


def _expand(batches, rows: int = 20_000):
    """At most ``rows`` lines are held at a time, whatever the size of a member."""
    import pandas as pd
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for info in zf.infolist():
                    if info.is_dir():
                        continue
                    with zf.open(info) as fh:
                        text = io.TextIOWrapper(fh, encoding="utf-8", errors="replace", newline="")
                        numbered = enumerate(text)
                        while part := list(itertools.islice(numbered, rows)):
                            yield pd.DataFrame({
                                "archive": path, "member": info.filename,
                                "line_no": [i for i, _ in part],
                                "line": [ln.rstrip("\r\n") for _, ln in part]})


#: Archives of this size and more do not go through ``binaryFile``, whose rows end at 2 GB.
LARGE = 1_500_000_000


class Member(InputPartition):
    """One member of one archive."""

    def __init__(self, archive: str, member: str):
        super().__init__(0)
        self.archive, self.member = archive, member


def _opened(uri: str) -> zipfile.ZipFile:
    """The archive by ranges: its directory now, a member's bytes when they are read."""
    from pyarrow import fs
    scheme, _, path = uri.partition(":")
    if scheme == "file":
        store, path = fs.LocalFileSystem(), "/" + path.lstrip("/")
    else:
        store, path = fs.FileSystem.from_uri(quote(uri, safe="/:@%"))
    return zipfile.ZipFile(store.open_input_file(path))


class _MemberReader(DataSourceReader):
    def __init__(self, archives: list[str], rows: int):
        self.archives, self.rows = archives, rows

    def partitions(self):
        found = []
        for uri in self.archives:
            with _opened(uri) as zf:
                found += [Member(uri, i.filename) for i in zf.infolist() if not i.is_dir()]
        return found

    def read(self, partition):
        import pyarrow as pa
        if not isinstance(partition, Member):            # no member at all
            return
        with _opened(partition.archive) as zf, zf.open(partition.member) as fh:
            numbered = enumerate(io.TextIOWrapper(fh, encoding="utf-8", errors="replace", newline=""))
            while part := list(itertools.islice(numbered, self.rows)):
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.archive] * n), pa.array([partition.member] * n), pa.array([i for i, _ in part], pa.int64()),
                     pa.array([ln.rstrip("\r\n") for _, ln in part])], names=LINES.fieldNames())


class ZipMembers(DataSource):
    """``spark.read.format("zip_members").option("archives", <uris, one a line>)``."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> T.StructType:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _MemberReader([x for x in self.options["archives"].split("\n") if x], int(self.options.get("rows", 20_000)))


def expand_members(spark: SparkSession, archives: list[str], rows: int = 20_000) -> DataFrame:
    """S5 for archives of any size: the columns of ``expand``, one partition a member."""
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zip_members").option("archives", "\n".join(archives)).option("rows", rows).load()


def expanded_base(path: str, txt_pattern: str):
    """Base name of the text that a file belongs to: the file itself, or the feed folder it lies in."""
    like = fnmatch.translate(txt_pattern)
    file, parent = base_name(path), F.element_at(F.split(path, "/"), -2)
    return F.when(parent.rlike(like), strip_extension(parent)).when(file.rlike(like), strip_extension(file))


def pending_archives(spark: SparkSession, folder: str, zip_pattern: str = "*.zip",
                     txt_pattern: str = "*.txt") -> DataFrame:
    """Archives whose base name has no expanded text file yet (content not read yet)."""
    zips = (spark.read.format("binaryFile").option("pathGlobFilter", zip_pattern)
            .option("recursiveFileLookup", "true").load(folder)
            .withColumn("base", strip_extension(base_name("path"))))
    txts = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
            .select(expanded_base("path", txt_pattern).alias("base")).filter("base is not null").distinct())
    return zips.join(txts, "base", "left_anti")


def expand(archives: DataFrame) -> DataFrame:
    """``(archive, member, line_no, line)`` for every line of every archive member."""
    return archives.select("path", "content").mapInPandas(_expand, LINES)


def expand_newest(spark: SparkSession, folder: str, zip_pattern: str = "*.zip",
                  txt_pattern: str = "*.txt") -> str | None:
    """S5 as the reference does it: the newest archive, chosen by metadata before any is opened, is
    expanded if its text has not landed yet; older archives stay closed.  The text lands as the feed
    folder ``<base>.txt`` beside the archive, written by Spark, so any store will do.  Returns that
    path, or None if there was nothing to expand."""
    newest = latest_file(spark, folder, zip_pattern)
    if newest is None:
        return None
    path, name = newest
    pending = pending_archives(spark, folder, name, txt_pattern).filter(F.col("path") == path)
    if pending.isEmpty():
        return None
    out = path[:path.rindex("/") + 1] + name[:name.rindex(".")] + ".txt"
    large = not pending.filter(F.col("length") >= LARGE).isEmpty()
    lines = expand_members(spark, [path]) if large else expand(pending)
    lines.select("line").write.mode("overwrite").text(out)
    return out

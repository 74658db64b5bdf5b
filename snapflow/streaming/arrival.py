"""Incremental file arrival (T1): each newly landed snapshot is merged exactly once, in
arrival order.

Two forms.  ``snapshot_stream`` + ``merge_arrivals``: a snapshot is one delimited file, as the
feeds arrive today.  ``marker_stream`` + ``merge_announced``: a snapshot is a folder of any
number of files (what a distributed writer produces), announced by a one-line marker file
``<folder>\t<as_of>`` once the folder is complete; the stream carries only markers and each
micro-batch reads its snapshot folder as an ordinary parallel batch scan.

A file source with ``maxFilesPerTrigger=1`` turns every landed file into its own micro-batch;
``foreachBatch`` runs the batch snapshot merge on it (a full snapshot per batch, not a delta),
and the checkpoint records which files were processed, so a restart — or a lost executor —
neither skips nor repeats a snapshot.  ``trigger(availableNow=True)`` processes what has
arrived and stops, which suits the monthly schedule; a continuous trigger works unchanged.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapflow.operators import merge as M
from snapflow.operators.checks import DataCheckError
from snapflow.operators.sinks import open_table
from snapflow.sources.delimited import open_quote, split_fields


BAD_LINE, OPEN_QUOTE = "_bad_line", "_open_quote"


def snapshot_stream(spark: SparkSession, folder: str, schema: T.StructType, sep: str = "|",
                    pattern: str = "*") -> DataFrame:
    """Rows of newly landed delimited files, with the file name, one file per micro-batch.

    Lines are split by the rule of ``read_delimited``.  ``schema`` is the header's layout; a header
    with the same names in another order fails the batch.  A line with surplus fields has itself in
    ``_bad_line``; ``merge_arrivals`` never merges it.  A line that ends inside quotes
    (``_open_quote``) fails the batch, as the lines after it belong to its record: snapshots with line
    breaks inside quotes come as announced folders, which ``read_delimited`` reads."""
    names = [f.name for f in schema.fields]
    lines = (spark.readStream.schema("value string").option("maxFilesPerTrigger", 1)
             .option("pathGlobFilter", pattern).option("latestFirst", "false").text(folder))
    line = F.col("value")
    rows = lines.where(line != "").select(
        line, split_fields(line, sep).alias("_f"), open_quote(line, sep).alias("_open"),
        F.col("_metadata.file_name").alias("FileName"))
    fields = F.transform("_f", F.trim)
    is_header = F.contains(line, F.lit(names[0])) & \
        (F.array_sort(fields) == F.array(*[F.lit(n) for n in sorted(names)]))
    wrong = F.raise_error(F.concat(F.lit("header in another order: "), line)).cast("boolean")
    is_row = F.when(~is_header, F.lit(True)) \
        .when(fields == F.array(*[F.lit(n) for n in names]), F.lit(False)).otherwise(wrong)
    bad = (F.size("_f") > len(names)) | F.col("_open")
    return rows.where(is_row).select(
        *[F.nullif(F.get("_f", F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name)
          for i, f in enumerate(schema.fields)], "FileName", F.when(bad, line).alias(BAD_LINE),
        F.col("_open").alias(OPEN_QUOTE))


def merge_arrivals(spark: SparkSession, stream: DataFrame, table_root: str, ms: M.MergeSpec,
                   checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
                   as_of_fn: Callable[[int], str] | None = None, buckets: int | None = None,
                   quarantine: str | None = None):
    """Start the stream; every micro-batch (one snapshot file) is prepared and merged with
    write-audit-publish.  Bad lines go to the Parquet folder ``quarantine``, one subfolder a batch;
    without one, a batch with a bad line fails.  Returns the StreamingQuery (call
    ``awaitTermination``)."""
    table = open_table(spark, table_root, buckets)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        if BAD_LINE in batch.columns:
            if OPEN_QUOTE in batch.columns:
                if not batch.where(OPEN_QUOTE).isEmpty():
                    raise DataCheckError(f"batch {epoch}: a line ends inside quotes; announce the snapshot as a folder")
                batch = batch.drop(OPEN_QUOTE)
            bad = batch.where(F.col(BAD_LINE).isNotNull()).select("FileName", F.col(BAD_LINE).alias("line"))
            if quarantine:
                bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={epoch}")
            elif not bad.isEmpty():
                raise DataCheckError(f"batch {epoch}: lines with surplus fields or an open quote, and no quarantine folder")
            batch = batch.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
        src = prepare(batch) if prepare else batch
        as_of = as_of_fn(epoch) if as_of_fn else None
        if as_of is None:
            as_of = batch.sparkSession.sql("select cast(current_timestamp() as timestamp_ntz)") \
                .first()[0].isoformat(sep=" ")
        M.merge_into_table(batch.sparkSession, table, src, ms, as_of)

    return (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


MARKER_SCHEMA = "value string"


def announce(spark: SparkSession, marker_folder: str, name: str, snapshot_path: str,
             as_of: str) -> None:
    """Land the marker of a complete snapshot folder.  It is written under a hidden name (the
    file source skips ``_``-prefixed files) and renamed, so the stream never sees half a marker;
    its modification time is kept after every earlier marker so arrival order is unambiguous."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    folder = Path(marker_folder)
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    latest = 0
    for st in fs.listStatus(folder):
        if st.getPath().getName().endswith(".ready"):
            latest = max(latest, st.getModificationTime())
    final, tmp = Path(folder, f"{name}.ready"), Path(folder, f"_{name}.ready.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(f"{snapshot_path}\t{as_of}\n".encode()))
    finally:
        out.close()
    fs.rename(tmp, final)
    mtime = fs.getFileStatus(final).getModificationTime()
    if mtime <= latest:
        fs.setTimes(final, latest + 1, -1)


def marker_stream(spark: SparkSession, marker_folder: str) -> DataFrame:
    """One marker (one line) per micro-batch, oldest first."""
    return (spark.readStream.schema(MARKER_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("pathGlobFilter", "*.ready").option("latestFirst", "false")
            .text(marker_folder).withColumn("marker", F.col("_metadata.file_name")))


def merge_announced(spark: SparkSession, markers: DataFrame, table_root: str, ms: M.MergeSpec,
                    checkpoint: str, read_snapshot: Callable[[SparkSession, str], DataFrame],
                    buckets: int | None = None):
    """Merge every announced snapshot into the versioned table at ``table_root``.

    Only the marker lines (one per batch) reach the driver; the snapshot itself is read by
    ``read_snapshot(spark, folder)`` as a distributed batch scan and merged with
    write-audit-publish.  If a batch is replayed after a failure, merging the same snapshot
    with the same ``as_of`` again changes nothing (matched rows compare equal, dropped rows
    keep their first drop time), so the table ends as if every snapshot was merged once."""
    table = open_table(spark, table_root, buckets)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        for m in sorted(batch.select("marker", "value").collect()):
            if not m["value"]:
                continue
            folder, as_of = m["value"].split("\t")
            src = read_snapshot(batch.sparkSession, folder)
            M.merge_into_table(batch.sparkSession, table, src, ms, as_of.strip())

    return (markers.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

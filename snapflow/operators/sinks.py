"""Sinks (K1-K3, K6) and versioned snapshot tables.

A stage is rebuilt by an overwrite write (drop + create + insert in one step).  A long-lived
merged table is a *versioned* folder: each merge writes ``v=<n>`` next to the previous version
and then moves a small pointer file, because Spark cannot safely overwrite a Parquet path it is
reading from.  Readers follow the pointer, so a failed or audited-out run never becomes visible
(write-audit-publish).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from snapflow.operators.checks import Contents, _contents, contents, counted, observed_contents


def rebuild_stage(df: DataFrame, path: str, max_records_per_file: int | None = None,
                  fmt: str = "parquet") -> int:
    """K1/K2/K3: replace the stage with ``df``; returns the rows written (observed in the same
    pass, no recount)."""
    obs_df, obs = counted(df, "stage")
    w = obs_df.write.mode("overwrite").format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)
    return obs.get["rows"]


def rebuild_reconciled(df: DataFrame, path: str, fmt: str = "parquet") -> tuple[Contents, Contents]:
    """K3 with R1: replace the stage with ``df``; (contents noted while writing, contents read back)."""
    noted, obs = observed_contents(df, "stage")
    noted.write.mode("overwrite").format(fmt).save(path)
    return _contents(obs.get), contents(df.sparkSession.read.format(fmt).load(path))


def load_into_empty(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """R2: load ``df`` into the stage at ``path`` only if that stage holds no rows yet; a stage
    that already has rows is refused (``DataCheckError``) instead of being appended to twice.
    The emptiness test reads at most one row; the load count is observed during the write."""
    from snapflow.operators.checks import require_empty
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    if fs.exists(p) and any(not st.getPath().getName().startswith(("_", "."))
                            for st in fs.listStatus(p)):
        require_empty(spark.read.format(fmt).load(path), f"stage {path}")
    obs_df, obs = counted(df, "load")
    obs_df.write.mode("append").format(fmt).save(path)
    return obs.get["rows"]


def default_buckets(spark: SparkSession) -> int:
    """Bucket count for a new versioned table: the session's shuffle partition count, so the
    bucketed side of a merge join is reused as is (Spark keeps an existing partitioning only
    when it has at least ``spark.sql.shuffle.partitions`` partitions)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_table(spark: SparkSession, root: str, buckets: int | None = None) -> "VersionedTable":
    """A versioned table bucketed by its merge key; ``buckets=0`` keeps plain files."""
    return VersionedTable(spark, root, default_buckets(spark) if buckets is None else buckets)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class VersionedTable:
    """Versions under ``root/v=<n>``; the highest ``root/_CURRENT.<n>`` names the published one.

    A version is published by creating its pointer file, which fails if it exists: nothing is ever
    deleted to publish, so readers always see a whole version, and of two writers that prepare the
    same version one fails.  A version folder is never written twice.  Folders left by a failed
    writer stop the next one until ``drop_unpublished()`` removes them.

    With a bucket count (``buckets=``, or recorded in ``root/_LAYOUT`` by the first write) every
    version is written with Spark's ``bucketBy(n, key)`` + ``sortBy(key)`` and read back as an
    external catalog table declared with the same clustering (K6).  The scan then reports
    hash partitioning on the key, so the next merge's join shuffles only the incoming
    snapshot, never the accumulated table.  A merge hands over its result in parts that still lie in
    those partitions (``merge.merge_parts``); ``write_next(..., clustered=True)`` writes them as they
    are, one file a bucket and part, without a shuffle.  Any other frame is shuffled by key once.

    Identities (M7) are claimed from a high-water mark beside the versions, ``root/_IDS.<first>``
    with the number of ids taken: no scan of the table, and of two writers that want the same first
    id one gets the next block.  A claim is never given back: a failed run leaves a gap.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root, self._buckets = spark, root.rstrip("/"), buckets

    def _pointer(self, version: int) -> str:
        return f"{self.root}/_CURRENT.{version:06d}"

    def _names(self, prefix: str) -> list[int]:
        """Numbers of the entries ``root/<prefix><n>``."""
        fs, p = _fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].isdigit())

    def _read_small(self, path: str) -> str | None:
        fs, p = _fs(self.spark, path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream))
            return (reader.readLine() or "").strip()
        finally:
            stream.close()

    def _write_small(self, path: str, text: str) -> None:
        """Create a one-line file; an existing one is an error."""
        fs, p = _fs(self.spark, path)
        if fs.getUri().getScheme() == "file":
            # Hadoop's local file system looks for the file and creates it in two steps, so two writers could both succeed
            local = p.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            with open(local, "x") as out:
                out.write(text)
            return
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def current_version(self) -> int | None:
        """The published version; ``None`` for a table without any version.  Versions without a
        pointer are a damaged or unfinished table, never an empty one."""
        published = self._names("_CURRENT.")
        if published:
            return published[-1]
        if self._names("v="):
            raise RuntimeError(f"{self.root} has versions but none is published; "
                               "restore a pointer or call drop_unpublished()")
        return None

    def _drop(self, version: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(version)}")
        for path in (self._pointer(version), self.path_of(version)):
            fs, p = _fs(self.spark, path)
            fs.delete(p, True)

    def drop_unpublished(self) -> list[int]:
        """Remove versions above the published one, left by writers that failed."""
        published = self._names("_CURRENT.")
        gone = [v for v in self._names("v=") if not published or v > published[-1]]
        for v in gone:
            self._drop(v)
        return gone

    def drop_versions(self, keep: int = 2) -> list[int]:
        """Remove all but the ``keep`` newest published versions; the current one always stays."""
        gone = self._names("_CURRENT.")[:-max(1, keep)]
        for v in gone:
            self._drop(v)
        return gone

    def layout(self) -> tuple[list[str], int] | None:
        """``(key columns, bucket count)`` of a bucketed table, else ``None``."""
        rec = self._read_small(f"{self.root}/_LAYOUT")
        if rec is None:
            return None
        keys, n = rec.split("\t")
        return keys.split(","), int(n)

    def path_of(self, version: int) -> str:
        return f"{self.root}/v={version:06d}"

    def _table_name(self, version: int) -> str:
        import hashlib
        return f"snapflow_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_v{version:06d}"

    def read(self) -> DataFrame | None:
        """The published version (``None`` before the first publish)."""
        v = self.current_version()
        return None if v is None else self.read_version(v)

    def read_version(self, v: int) -> DataFrame:
        """Any written version, published or not (the audit reads the new one this way, so
        its key check runs on the bucketed layout without a shuffle)."""
        lay = self.layout()
        if lay is None:
            return self.spark.read.parquet(self.path_of(v))
        keys, n = lay
        name = self._table_name(v)
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(self.path_of(v)).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            kl = ", ".join(f"`{k}`" for k in keys)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                           f"CLUSTERED BY ({kl}) SORTED BY ({kl}) INTO {n} BUCKETS "
                           f"LOCATION '{self.path_of(v)}'")
        return self.spark.table(name)

    def claim_ids(self, count: int, start: int, issued=None) -> int:
        """The first of ``count`` consecutive ids that no other writer gets.  ``issued()``, asked only
        for a table without claims, gives the highest id that was issued before claims were kept."""
        import time
        for _ in range(100):
            taken = self._names("_IDS.")
            if taken:
                number = self._read_small(f"{self.root}/_IDS.{taken[-1]:020d}")
                if not number:
                    time.sleep(0.1)              # another writer has just created it
                    continue
                first = max(start, taken[-1] + int(number))
            else:
                highest = issued() if issued else None
                first = start if highest is None else max(start, highest + 1)
            if not count:
                return first
            try:
                self._write_small(f"{self.root}/_IDS.{first:020d}", str(count))
            except Exception:                    # noqa: BLE001 - raised again unless another writer was first
                if first not in self._names("_IDS."):
                    raise
                continue
            return first
        raise RuntimeError(f"{self.root}: no identities could be claimed; the newest _IDS file may be an unfinished claim")

    def write_next(self, df, key=None, clustered: bool = False) -> tuple[int, str]:
        """Write a new, unpublished version; with ``key`` rows are clustered by key inside each
        file (K6), and bucketed by key when the table has (or is given) a bucket count.  ``df`` is a
        frame or a list of frames; ``clustered``: each lies in the buckets' hash partitions already."""
        v = (self.current_version() or 0) + 1
        keys = [key] if isinstance(key, str) else list(key or [])
        lay = self.layout()
        if lay is None and self._buckets and keys:
            lay = (keys, int(self._buckets))
            self._write_small(f"{self.root}/_LAYOUT", f"{','.join(keys)}\t{lay[1]}")
        path = self.path_of(v)
        fs, p = _fs(self.spark, path)
        if fs.exists(p):
            raise FileExistsError(f"{path} exists: another writer is at it, or one failed "
                                  "(then call drop_unpublished())")
        for k, part in enumerate(df if isinstance(df, list) else [df]):
            self._write_part(part, v, keys, lay, clustered, "append" if k else "errorifexists")
        return v, path

    def _write_part(self, df: DataFrame, version: int, keys: list[str], lay, clustered: bool, mode: str) -> None:
        if lay is None:
            out = df.sortWithinPartitions(*keys) if keys else df
            out.write.mode(mode).parquet(self.path_of(version))
            return
        bkeys, n = lay
        # one file a bucket: without this each input task writes a file for each bucket
        out = df if clustered else df.repartition(n, *bkeys)
        (out.write.mode(mode).format("parquet").bucketBy(n, *bkeys).sortBy(*bkeys)
         .option("path", self.path_of(version)).saveAsTable(self._table_name(version)))

    def publish(self, version: int) -> None:
        self._write_small(self._pointer(version), str(version))

"""Session construction and the shared scratch location.

Lineage is cut with tables written below the folder that the cluster names in
``spark.checkpoint.dir`` (``materialize``) or with ``DataFrame.checkpoint()`` into it.  That setting is read from the running session;
a private one is created only when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the member-extract merge row is ~250 fields wide; keep it inside whole-stage codegen
    "spark.sql.codegen.maxFields": "400",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "snapflow", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``snapflow`` importable in Python workers (``applyInPandas`` / ``mapInPandas``
    steps): the package is zipped in memory, written to the shared checkpoint folder through
    the Hadoop file system API and added with ``addPyFile`` — the same thing ``--py-files``
    does at submit time.  Once per application."""
    import io
    import zipfile
    import snapflow
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(snapflow.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, dirs, files in os.walk(root):
            dirs[:] = [x for x in dirs if x != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.join("snapflow", os.path.relpath(full, root)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapflow-py/{uuid.uuid4().hex[:12]}/snapflow.zip"
    jvm = sc._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(p.toString())
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's setting, or a private one for local runs."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="snapflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def materialize(df, name: str, bucket_by: tuple[list[str], int] | None = None):
    """Cut lineage by writing ``df`` as a Parquet table under the shared checkpoint folder and
    reading it back.  Unlike ``DataFrame.checkpoint()`` (which computes the plan once for the
    action and again for the checkpoint files, and stores serialized rows), the plan runs once,
    the copy is columnar, and later scans get column pruning, pushed filters and file-size
    statistics for AQE.  The folder is shared, so the copy survives a lost executor.
    ``bucket_by=(keys, n)`` writes the copy bucketed (an external catalog table), so key
    aggregates and joins against tables bucketed the same way need no exchange."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if bucket_by is None:
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        out._snapflow_copy = (path, None)
        return out
    # bucketed copy: later aggregates and joins on the key reuse its hash partitioning; one task
    # holds one bucket, so there is one file a bucket however many tasks made the rows
    keys, n = bucket_by
    table = f"snapflow_{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet").bucketBy(n, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    out = spark.table(table)
    out._snapflow_copy = (path, table)      # folder and catalog table, for ``release``
    return out


def release(df) -> None:
    """Delete a copy made by ``materialize`` once nothing reads it any more (its catalog entry
    and its folder in the shared checkpoint location)."""
    entry = getattr(df, "_snapflow_copy", None)
    if entry is None:
        return
    df._snapflow_copy = None
    path, table = entry
    spark = df.sparkSession
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")       # external table: data stays until below
    drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared checkpoint location that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(df, *keys: str, per_core: int = 4):
    """``df`` in a fixed number of hash partitions by ``keys``, a few a core of the cluster.  Adaptive
    execution sizes a shuffle by the bytes that go in, so it would leave narrow rows that a step turns
    into workbooks or wide text to one task; a number that is asked for stays."""
    return df.repartition(per_core * df.sparkSession.sparkContext.defaultParallelism, *keys)


def together(*jobs) -> list:
    """The results of independent ``jobs`` (functions without arguments), submitted at once so that
    short ones share the cluster.  All end before the first error is raised."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job) for job in jobs]
    return [r.result() for r in running]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for staged tables and round trips."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/snapflow/{name}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path

"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every one of them is also safe on local[N].
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The only broadcasts are AQE's runtime choices, bounded by measured size.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Detail records can be tens of MiB each: keep Arrow batches and file
    # splits small enough that one task never holds a whole round.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.maxBytesPerOutputBatch": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "catalog_lake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the engine defaults applied.

    On a cluster pass no master and size ``shuffle_partitions`` to the data
    (≈ input bytes / 128 MiB); tests use ``local[*]`` with 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("_", "."), v)
    spark = builder.getOrCreate()
    if is_classic(spark):
        spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_code(spark)
    return spark


def is_classic(spark: SparkSession) -> bool:
    """True for a classic (JVM-backed) session, False for Spark Connect."""
    try:
        return spark.sparkContext is not None
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return False


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a run over ``input_bytes`` of Parquet on a cluster.

    Start with roughly one shuffle partition per 128 MiB of input (never fewer
    than two per core) and let AQE coalesce small ones and split skewed ones;
    e.g. 100 TB on 1000 executors x 8 cores gives ~780k initial partitions.
    """
    cores = max(1, executor_cores * executors)
    n = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to shared storage and we only read it.
    Only when it is unset (tests, a laptop) do we create a private one.  The
    SparkContext's checkpoint directory is pointed at it once (Spark adds a
    per-application sub-folder there for ``DataFrame.checkpoint``).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master if is_classic(spark) else ""
        if is_classic(spark) and not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="catalog-lake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not is_classic(spark):
        return current
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if is_classic(spark):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable by Python workers (pandas UDFs, ``mapInPandas``).

    Executors run their own Python processes; they import the functions
    pickled by reference from ``catalog_lake``.  The package is zipped in
    memory once per application, written into the shared checkpoint folder
    and added with ``addPyFile`` (what ``--py-files`` does), so executors
    fetch it from shared storage — nothing is staged in a machine-local folder.
    """
    classic = is_classic(spark)
    app = spark.sparkContext.applicationId if classic else f"connect-{spark.session_id}"
    if app in _SHIPPED:
        return
    import hashlib
    import io
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in sorted(os.walk(pkg)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    name = f"catalog_lake-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    if classic:
        path = f"{checkpoint_dir(spark).rstrip('/')}/code/{name}"
        jvm = spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(path)
        fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(hp):
            out = fs.create(hp, True)
            out.write(bytearray(data))
            out.close()
        spark.sparkContext.addPyFile(path)
    else:
        stage = tempfile.mkdtemp(prefix="catalog-lake-code-")  # Connect uploads from the client
        local = os.path.join(stage, name)
        with open(local, "wb") as fh:
            fh.write(data)
        spark.addArtifacts(local, pyfile=True)
    _SHIPPED.add(app)

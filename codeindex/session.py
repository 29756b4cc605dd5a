"""Session helpers: table loading, shared scratch folder, code shipping."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[*]", partitions: int = 8, app: str = "codeindex") -> SparkSession:
    """Session used by tests and the bench; on a cluster the launcher's session is used as is."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> None:
    """Settings the transforms rely on (UTC epochs); harmless to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by spark.checkpoint.dir.

    Only when the setting is absent (local tests) a fresh scratch folder is
    created and registered, so lineage cuts and index tables always land on
    storage every executor can read.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not d and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="codeindex-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder."""
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Bytes of table files behind one partition of a shuffle; adaptive execution joins the small ones.
PARTITION_BYTES = 4 << 20


def sized_shuffles(spark: SparkSession, sf_dir: str) -> None:
    """Let adaptive shuffles start from as many partitions as the tables' size asks for, so that no task's share grows with it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))


_REGISTERED: dict[str, str] = {}


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Expose the given parquet tables as temp views named after the files (once per session and folder)."""
    configure(spark)
    sid = spark.sparkContext.applicationId
    if _REGISTERED.get(sid) == sf_dir and spark.catalog.tableExists("documents"):
        return
    _REGISTERED[sid] = sf_dir
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path) or "://" in sf_dir:
            table(spark, sf_dir, name).createOrReplaceTempView(name)


# Rows of an Arrow batch between Spark and a worker: texts are wide, and both sides hold whole batches.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows; a smaller bound of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def release() -> None:
    """Give memory that a task has freed back to the system, as workers live on."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def swept(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished jobs now: it does so once the driver's memory is collected."""
    spark._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``codeindex`` importable in every Python worker (once per SparkContext).

    The Arrow UDFs refer to helpers of this package, so executors must be able
    to import it. The package's .py files are zipped on the driver and handed to
    ``SparkContext.addPyFile``, which distributes them with the job, the same way
    on a cluster as in local mode.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="codeindex-pkg-"), "codeindex.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)

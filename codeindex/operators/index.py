"""Index sinks (K01-K05, W01, U02, A03, P11): keyed upsert tables and their catalogue.

An index table is a Parquet folder partitioned by ``run_no``, ``batch_no`` and ``index_name``. A run is one writer: a
batch job or a stream with its checkpoint; run numbers ascend, so (run_no, batch_no) orders the versions of a document.
Writing a batch again replaces its folder, so a retried or replayed batch is idempotent, and no run touches the folders
of another. Reading applies last-write-wins per (index_name, id): the older versions are found on the keys alone, which
is the only shuffle, and anti-joined from the rows; they are few, so Spark broadcasts them and the documents
themselves stay where they are. Nothing is ever deleted, as in the reference.
"""

from __future__ import annotations

import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Index attribute configuration (order = rank) and vector size.
# ---------------------------------------------------------------------------
INDEX_CONFIG: dict[str, dict[str, list[str]]] = {
    "code": {
        "searchable": ["text", "file_path", "metadata.class_name", "metadata.function_name"],
        "filterable": ["repository_id", "owner", "language", "category", "source",
                       "metadata.class_name", "metadata.function_name"],
        "sortable": ["repository_id"],
    },
    "pr": {
        "searchable": ["title", "body", "commit_messages", "changed_files"],
        "filterable": ["repository_id", "owner", "repo_name", "state", "author", "labels", "milestone",
                       "changed_files", "created_at", "updated_at", "merged_at", "closed_at",
                       "changed_files_count", "additions", "deletions"],
        "sortable": ["created_at", "updated_at", "merged_at", "closed_at", "changed_files_count",
                     "additions", "deletions"],
    },
}
VECTOR_DIMS = 3072
PRIMARY_KEY = "id"
# ---------------------------------------------------------------------------

KEYS = ["index_name", PRIMARY_KEY]


def config_rows() -> list[tuple[str, str, str, int]]:
    return [(kind, role, attr, rank) for kind, roles in INDEX_CONFIG.items()
            for role, attrs in roles.items() for rank, attr in enumerate(attrs)]


def catalogue(spark: SparkSession, index_names: DataFrame) -> DataFrame:
    """One row per (index, role, attribute, rank) for the indexes in use.

    ``index_names`` carries (index_name, kind); the kind is explicit rather than
    guessed from the name. The config side is a fixed 30-row table.
    """
    cfg = spark.createDataFrame(config_rows(), "kind string, role string, attribute string, rank int")
    out = index_names.select("index_name", "kind").distinct().join(F.broadcast(cfg), "kind")
    return out.withColumn("dims", F.lit(VECTOR_DIMS)).withColumn("primary_key", F.lit(PRIMARY_KEY))


VERSION = ["run_no", "batch_no"]
# a hash of the row and its place in the batch: they order rows of one key within a batch
ROW = ["_row", "_at"]


def replaced(keyed: DataFrame) -> DataFrame:
    """W01 on keys alone: (index_name, id, run_no, batch_no, _at) of every version that a newer one replaces."""
    newest = Window.partitionBy(*KEYS).orderBy(*[F.col(c).desc() for c in [*VERSION, *ROW]])
    return keyed.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") > 1).select(*KEYS, *VERSION, "_at")


class IndexTable:
    """A keyed index table stored as batch folders under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self) -> bool:
        fs, path = self._fs(self.root)
        return fs.exists(path)

    def new_run(self) -> int:
        """Reserve the next run number; creating its marker file is atomic, so no two writers share one."""
        run = 1
        while True:
            fs, path = self._fs(f"{self.root}/_runs/{run}")
            if fs.createNewFile(path):
                return run
            run += 1

    def run_of(self, checkpoint: str) -> int:
        """The run of a stream: reserved with a new checkpoint and kept in it, so that a restart goes on with it."""
        fs, path = self._fs(f"{checkpoint.rstrip('/')}/_index_runs/{zlib.crc32(self.root.encode())}")
        if fs.exists(path):
            return int(fs.listStatus(path)[0].getPath().getName())
        run = self.new_run()
        fs.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(path, str(run)))
        return run

    def write_batch(self, docs: DataFrame, batch_no: int, check_empty: bool = True, run_no: int = 0) -> bool:
        """K01 + U02: write one batch, which replaces older versions of its documents and an earlier try of itself.

        An empty batch is a no-op (K04). Returns whether a write ran. With ``check_empty=False`` the emptiness probe (an
        extra job) is skipped: an empty frame then leaves a folder without files.
        """
        if check_empty and docs.isEmpty():
            return False
        hashable = [c for c, t in docs.dtypes if not t.startswith("map")]
        (docs.withColumn("_row", F.xxhash64(*hashable)).withColumn("_at", F.monotonically_increasing_id())
             .write.mode("overwrite").option("compression", "zstd").partitionBy("index_name").parquet(f"{self.root}/run_no={int(run_no)}/batch_no={int(batch_no)}"))
        return True

    def _folders(self, path: str, prefix: str) -> list[str]:
        fs, p = self._fs(path)
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted((f"{path}/{n}" for n in names if n.startswith(prefix)), key=lambda x: int(x.rpartition("=")[2]))

    def _schema(self) -> T.StructType:
        """Columns of the newest batch of every run; a run's batches have the same ones. The types of the folder columns
        are stated, as an index name may look like a number."""
        fields: dict[str, T.StructField] = {}
        for run in self._folders(self.root, "run_no="):
            for batch in reversed(self._folders(run, "batch_no=")):
                try:
                    own = self.spark.read.parquet(batch).schema
                except AnalysisException:  # a batch without files
                    continue
                fields |= {f.name: f for f in own if f.name != "index_name"}
                break
        if not fields:
            raise FileNotFoundError(f"index table {self.root} holds no batch yet")
        return T.StructType([*fields.values(), T.StructField("run_no", T.LongType()), T.StructField("batch_no", T.LongType()),
                             T.StructField("index_name", T.StringType())])

    def raw(self) -> DataFrame:
        """Every version of every document."""
        return self.spark.read.schema(self._schema()).parquet(self.root)

    def read(self, index_name: str | None = None) -> DataFrame:
        """The current documents: the newest version per (index_name, id); of one index only its folders are read."""
        rows = self.raw()
        if index_name is not None:
            rows = rows.where(F.col("index_name") == index_name)
        old = replaced(rows.select(*KEYS, *VERSION, *ROW))
        return rows.join(old, [*KEYS, *VERSION, "_at"], "left_anti").drop(*VERSION, *ROW)


def docs_per_index(docs: DataFrame) -> DataFrame:
    """Documents per index."""
    return docs.groupBy("index_name").agg(F.count(F.lit(1)).alias("n_docs"))


def rejects(stage: str, df: DataFrame, key, reason) -> DataFrame:
    """A dead-letter row (stage, key, reason) per failed record."""
    key_c = F.col(key) if isinstance(key, str) else key
    reason_c = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(F.lit(stage).alias("stage"), key_c.cast("string").alias("key"), reason_c.alias("reason"))

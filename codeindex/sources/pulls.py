"""Pull-request payload sources (S07-S09): landed JSON -> typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import swept


def read_pulls(spark: SparkSession, path: str) -> DataFrame:
    """One pull payload per JSON line, explicit schema (no inference)."""
    return spark.read.schema(schemas.PULL).json(path)


def read_pull_files(spark: SparkSession, path: str) -> DataFrame:
    """One files listing per pull -> one row per file with its 1-based position."""
    raw = spark.read.schema(schemas.PULL_FILES).json(path)
    return raw.select("repository_id", "pr_number", F.posexplode("files").alias("pos", "f")).select(
        "repository_id", "pr_number", (F.col("pos") + 1).cast("long").alias("position"),
        F.col("f.filename").alias("filename"), F.col("f.additions").alias("additions"),
        F.col("f.deletions").alias("deletions"))


def read_pull_commits(spark: SparkSession, path: str) -> DataFrame:
    """One commits listing per pull -> one row per commit message in order."""
    raw = spark.read.schema(schemas.PULL_COMMITS).json(path)
    return raw.select("repository_id", "pr_number", F.posexplode("commits").alias("pos", "c")).select(
        "repository_id", "pr_number", (F.col("pos") + 1).cast("long").alias("position"),
        F.col("c.commit.message").alias("message"))


# ---- fixture landing (test scaffolding: fixture views -> API-shaped records) ---

def pulls_payload(fx_pulls: DataFrame) -> DataFrame:
    """fx_pulls -> pulls-endpoint records.

    The fixture has no update, merge or URL fields: a pull without later
    activity is landed with updated_at = created_at, merged_at = null and the
    web URL of its repository (named like the request fixtures name it).
    """
    extras = F.from_json("payload", schemas.PULL_EXTRAS)
    rid = F.col("repository_id")
    url = F.concat(F.lit("https://github.com/org"), (rid % 5).cast("string"), F.lit("/repo-"),
                   rid.cast("string"), F.lit(".x/pull/"), F.col("pr_number").cast("string"))
    return fx_pulls.select(
        "repository_id", F.col("pr_number").alias("number"), "title", "body", "state", "created_at",
        F.col("created_at").alias("updated_at"), "closed_at", F.lit(None).cast("string").alias("merged_at"),
        url.alias("html_url"), extras["user"].alias("user"), extras["labels"].alias("labels"),
        extras["milestone"].alias("milestone"))


def pull_files_payload(fx_pull_files: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("position", "filename", "additions", "deletions")))
    return fx_pull_files.groupBy("repository_id", "pr_number").agg(
        F.transform(ordered, lambda x: F.struct(x["filename"].alias("filename"), x["additions"].alias("additions"),
                                                x["deletions"].alias("deletions"))).alias("files"))


def pull_commits_payload(fx_pull_commits: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("position", "message")))
    return fx_pull_commits.groupBy("repository_id", "pr_number").agg(
        F.transform(ordered, lambda x: F.struct(F.struct(x["message"].alias("message")).alias("commit"))).alias("commits"))


# ---- ingest: parse the JSON payloads once into bucketed parquet ---------------

# Bytes of landed JSON behind one payload partition.
BUCKET_BYTES = 64 << 20
MIN_BUCKETS = 8
# Bytes of JSON behind a byte of a gzip file, about.
PACKED = 10


def bucket_of(buckets: int, number: str = "pr_number") -> Column:
    """The payload partition of a pull."""
    return F.pmod(F.xxhash64("repository_id", number), F.lit(buckets)).cast("int")


def landed_bytes(spark: SparkSession, *paths: str) -> int:
    total = 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files = fs.listFiles(path, True)
        while files.hasNext():
            st = files.next()
            total += st.getLen() * (PACKED if st.getPath().getName().endswith(".gz") else 1)
    return total


def ingest_payloads(spark: SparkSession, pulls_json: str, files_json: str, commits_json: str,
                    out_root: str) -> tuple[dict[str, str], int]:
    """Parse landed JSON payloads once into parquet partitioned by ``pr_bucket``; returns the paths and the bucket count.

    A stream joining its batch's pulls (with their buckets) against these tables
    reads only the matching partitions (dynamic partition pruning), so the
    per-batch cost follows the batch instead of re-parsing every payload. The
    number of buckets follows the size of the payloads.
    """
    buckets = max(MIN_BUCKETS, -(-landed_bytes(spark, pulls_json, files_json, commits_json) // BUCKET_BYTES))
    paths = {}
    tables = {
        "pulls": (read_pulls(spark, pulls_json), "number"),
        "files": (read_pull_files(spark, files_json), "pr_number"),
        "commits": (read_pull_commits(spark, commits_json), "pr_number"),
    }
    for name, (df, number) in tables.items():
        path = f"{out_root}/{name}"
        # rows sorted by pull inside a bucket (tight row-group statistics)
        (df.withColumn("pr_bucket", bucket_of(buckets, number)).repartition("pr_bucket")
           .sortWithinPartitions("pr_bucket", "repository_id", number)
           .write.mode("overwrite").option("compression", "zstd").partitionBy("pr_bucket").parquet(path))
        paths[name] = path
        swept(spark)
    return paths, buckets

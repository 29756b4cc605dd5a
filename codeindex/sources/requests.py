"""Request sources (S01-S03): batch and streaming readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def _normalise_repo(df: DataFrame) -> DataFrame:
    # The token is never stored: it is dropped at the source.
    return df.select("repository_id", "owner", "repo_name",
                     F.coalesce(F.col("branch"), F.lit("main")).alias("branch"))


def read_repo_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return _normalise_repo(spark.read.schema(schemas.REPO_REQUEST).format(fmt).load(path))


def stream_repo_requests(spark: SparkSession, path: str, fmt: str = "json",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schemas.REPO_REQUEST).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _normalise_repo(r.load(path))


def _normalise_pr(df: DataFrame) -> DataFrame:
    return df.drop("github_token")


def read_pr_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return _normalise_pr(spark.read.schema(schemas.PR_REQUEST).format(fmt).load(path))


def stream_pr_requests(spark: SparkSession, path: str, fmt: str = "json",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schemas.PR_REQUEST).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _normalise_pr(r.load(path))


def read_issue_requests(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Issue requests are declared but have no consumer: they land as a table only."""
    return spark.read.schema(schemas.ISSUE_REQUEST).format(fmt).load(path).drop("github_token")

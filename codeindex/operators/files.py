"""Archive entries / tree items -> supported source files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.languages import with_language

FILE_COLUMNS = ["repository_id", "file_path", "content", "language", "size"]


def clean_entries(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """F01 + P01 + F02: drop directories, strip the top folder, drop empty paths."""
    return (entries.where(~C.is_directory(F.col(entry)))
                   .withColumn("file_path", C.clean_zip_path(F.col(entry)))
                   .where(F.col("file_path") != ""))


def supported_files(files: DataFrame, path: str = "file_path") -> DataFrame:
    """F03 + F04 + P02: drop hidden paths, keep supported languages, attach the language."""
    return with_language(files.where(~C.is_hidden(F.col(path))), path, "language", how="inner")


def decode_content(files: DataFrame, content: str = "content") -> DataFrame:
    """F05 + P03: byte size and UTF-8 text. Binary input that is not valid UTF-8 is dropped."""
    dtype = dict(files.dtypes)[content]
    if dtype == "binary":
        return (files.withColumn("size", F.octet_length(F.col(content)))
                     .where(C.is_valid_utf8_bytes(F.col(content)))
                     .withColumn(content, F.col(content).cast("string")))
    return files.withColumn("size", F.octet_length(F.col(content)))


def entries_to_files(entries: DataFrame, entry: str = "entry", content: str = "content") -> DataFrame:
    """Archive entries -> (repository_id, file_path, content, language, size, ...).

    Path predicates run before the content is touched, so unsupported entries
    never have their bytes decoded.
    """
    files = supported_files(clean_entries(entries, entry))
    return decode_content(files, content)


def utf8_rejects(files: DataFrame, content: str = "content") -> DataFrame:
    """The files F05 drops (binary input only), for the reject log."""
    return files.where(~C.is_valid_utf8_bytes(F.col(content)))


def attach_requests(files: DataFrame, requests: DataFrame) -> DataFrame:
    """Every file row carries the owner / repo_name of the request for its repository and branch."""
    req = requests.select("repository_id", "owner", "repo_name",
                          F.coalesce(F.col("branch"), F.lit("main")).alias("branch")).distinct()
    own = files.withColumn("branch", F.coalesce(F.col("branch"), F.lit("main")))
    return own.join(req, ["repository_id", "branch"])


def scan_stats(entries: DataFrame, entry: str = "entry", content: str = "content") -> DataFrame:
    """Entries seen vs files kept, per repository (one pass, partial aggregation)."""
    is_file = ~C.is_directory(F.col(entry))
    path = C.clean_zip_path(F.col(entry))
    flagged = with_language(entries.withColumn("_p", path), "_p", "_lang", how="left")
    keep = (is_file & (F.col("_p") != "") & ~C.is_hidden(F.col("_p")) & (F.col("_lang") != "unknown"))
    dtype = dict(entries.dtypes)[content]
    if dtype == "binary":
        keep = keep & C.is_valid_utf8_bytes(F.col(content))
    return flagged.groupBy("repository_id").agg(
        F.count(F.lit(1)).alias("entries_seen"),
        F.count_if(keep).alias("files_kept"))

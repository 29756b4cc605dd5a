"""Repository archives (S04, S10): zip files in folders by repository and branch -> one row per archive entry.

Archives lie below one root as ``repository_id=<id>/branch=<escaped branch>/<part>.zip`` and are read with Spark's
``binaryFile`` source, so a join on the two folder columns prunes folders at run time, a condition on ``length`` is
pushed to the scan (archives over a limit are never opened), and a scan of sizes reads no archive at all.
``binaryFile`` packs files into tasks by spark.sql.files.maxPartitionBytes, so a task holds a bounded number of archive
bytes; entries are yielded archive by archive in slices, and names are checked (directory, hidden, supported language)
before an entry's bytes are read.
"""

from __future__ import annotations

import io
import zipfile
from itertools import islice
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.languages import lookup_rows
from ..session import ship_package

KEY = ["repository_id", "branch"]
ENTRY_SCHEMA = "repository_id long, branch string, entry string, content binary, error string"
SLICE_ROWS = 512


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Archive files as (repository_id, branch, path, length, content); what the folders do not name is null."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "false").load(path)
    named = lambda c, kind: F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)
    return df.select(named("repository_id", "long").alias("repository_id"), named("branch", "string").alias("branch"), "path", "length", "content")


def archive_sizes(archives: DataFrame) -> DataFrame:
    """(repository_id, branch, n_bytes, n_archives) from file lengths alone; no archive is opened."""
    return archives.groupBy(*KEY).agg(F.sum("length").alias("n_bytes"), F.count(F.lit(1)).alias("n_archives"))


def _supported_name(entry: str, keys: frozenset) -> bool:
    if entry.endswith("/") or "/" not in entry:
        return False
    path = entry.split("/", 1)[1]
    if not path or "/." in path or path.startswith("."):
        return False
    name = path.rsplit("/", 1)[-1]
    key = ("." + name.rsplit(".", 1)[1]) if "." in name else name
    return key.lower() in keys


def expand_archives(archives: DataFrame, repo_col: str = "repository_id", content_col: str = "content",
                    prefilter: bool = True) -> DataFrame:
    """(repository_id, branch, zip bytes) rows -> (repository_id, branch, entry, content bytes) rows.

    With ``prefilter`` only entries that can survive the path filters are read;
    without it every entry is listed (directories with empty content).
    """
    return read_entries(archives, repo_col, content_col, prefilter).where("error is null").drop("error")


def archive_rejects(archives: DataFrame, repo_col: str = "repository_id", content_col: str = "content") -> DataFrame:
    """(repository_id, branch, entry, error) of archives that cannot be opened and of entries that cannot be read."""
    return read_entries(archives, repo_col, content_col, True).where("error is not null").drop("content")


def read_entries(archives: DataFrame, repo_col: str = "repository_id", content_col: str = "content", prefilter: bool = True) -> DataFrame:
    """Entries with their bytes or, where reading failed, the error; one bad archive never stops the others."""
    ship_package(archives.sparkSession)
    keys = frozenset(k for k, _ in lookup_rows())

    def entries(blob):
        try:
            z = zipfile.ZipFile(io.BytesIO(blob if blob is not None else b""))
        except Exception as exc:
            yield None, None, f"bad archive: {type(exc).__name__}"
            return
        with z:
            for info in z.infolist():
                name = info.filename
                if prefilter and not _supported_name(name, keys):
                    continue
                try:
                    yield name, b"" if name.endswith("/") else z.read(info), None
                except Exception as exc:
                    yield name, None, f"bad entry: {type(exc).__name__}"

    def run(batches):
        for pdf in batches:
            for rid, branch, blob in zip(pdf["repository_id"], pdf["branch"], pdf["content"]):
                source = entries(blob)
                while rows := list(islice(source, SLICE_ROWS)):
                    names, contents, errors = zip(*rows)
                    yield pd.DataFrame({"repository_id": rid, "branch": branch, "entry": names, "content": contents, "error": errors})

    branch = F.col("branch") if "branch" in archives.columns else F.lit(None).cast("string")
    return archives.select(F.col(repo_col).alias("repository_id"), branch.alias("branch"), F.col(content_col).alias("content")).mapInPandas(run, ENTRY_SCHEMA)


# ---- fixture landing (test scaffolding) -----------------------------------------

PER_ARCHIVE = 500


def land_archives(entries: DataFrame, path: str, damaged: Column | None = None) -> None:
    """Write (repository_id, branch, entry, content) rows as zip files of at most about ``PER_ARCHIVE`` entries each.

    A repository with many entries is split over several archives (its rows are hashed into ceil(n / PER_ARCHIVE) parts),
    so no single group grows with the data. Entries are stored, not compressed, so a file's length follows from its
    entries. Archives of ``damaged`` keys are cut after 20 bytes. A file is written under another name and then moved,
    so a repeated task leaves whole files only.
    """
    ship_package(entries.sparkSession)
    counts = entries.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / PER_ARCHIVE)).cast("long")
    keyed = entries.join(counts, KEY).withColumn("part", F.pmod(F.xxhash64("entry"), parts)).drop("_n")
    keyed = keyed.withColumn("cut", F.lit(False) if damaged is None else damaged).select(*KEY, "part", "entry", "content", "cut")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
            for name, data in zip(pdf["entry"], pdf["content"]):
                if name.endswith("/"):
                    z.writestr(zipfile.ZipInfo(name), b"")
                else:
                    z.writestr(name, data if isinstance(data, (bytes, bytearray)) else str(data).encode("utf-8"))
        data = buf.getvalue()[:20] if pdf["cut"].iloc[0] else buf.getvalue()
        rid, branch, part = int(pdf["repository_id"].iloc[0]), str(pdf["branch"].iloc[0]), int(pdf["part"].iloc[0])
        store, root = fs.FileSystem.from_uri(path)
        folder = f"{root}/repository_id={rid}/branch={quote(branch, safe='')}"
        store.create_dir(folder)
        with store.open_output_stream(f"{folder}/_{part}.tmp") as out:
            out.write(data)
        store.move(f"{folder}/_{part}.tmp", f"{folder}/{part}.zip")
        return pd.DataFrame({"n": [len(data)]})

    keyed.groupBy(*KEY, "part").applyInPandas(pack, "n long").agg(F.sum("n")).collect()

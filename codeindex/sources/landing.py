"""Land fixture-derived records as files in the shared folder, once per session.

The engine's sources read files (JSON lines, parquet, archives); the registered
queries land their fixture view in that shape first, then read it back through
the source. Paths are cached per (session, table dir, name) so repeated queries
reuse one landing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import new_path, swept

_LANDED: dict[tuple, str] = {}
# Rows of a packed file, which one task reads as a whole.
FILE_ROWS = 200_000


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
           fmt: str = "json", parts: int | None = None, by: str | None = None, packed: bool = False) -> str:
    """``packed``: as gzip files of at most FILE_ROWS rows, which are read side by side."""
    key = (spark.sparkContext.applicationId, sf_dir, name, fmt)
    if key not in _LANDED:
        path = new_path(spark, f"landing-{name}")
        df = build()
        if parts:
            df = df.repartition(parts)
        w = df.write.mode("overwrite").format(fmt)
        if packed:
            w = w.options(compression="gzip", maxRecordsPerFile=FILE_ROWS)
        (w.partitionBy(by) if by else w).save(path)
        del df, w
        swept(spark)
        _LANDED[key] = path
    return _LANDED[key]

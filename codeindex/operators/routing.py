"""Archive-vs-tree routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT_MB = 50  # fixed value: default archive size limit


def route_repositories(sizes: DataFrame, limit_mb: float | None = None, size_col: str = "n_bytes",
                       keys: tuple[str, ...] = ("repository_id",)) -> DataFrame:
    """Per key (a repository, or its branch): 'archive' when the size is unknown or within the limit, else 'tree'.

    A limit of 0 / None means the default (50 MB); equality is allowed.
    """
    limit = limit_mb or DEFAULT_LIMIT_MB
    mb = F.col(size_col) / 1024 / 1024
    return sizes.select(*keys, mb.alias("size_mb"),
                        F.when(mb.isNull() | (mb <= F.lit(float(limit))), F.lit("archive"))
                         .otherwise(F.lit("tree")).alias("route"))


def on_route(routes: DataFrame, rows: DataFrame, route: str, keys: tuple[str, ...] = ("repository_id",)) -> DataFrame:
    """The rows (archives, listing items, files) of the repositories on one route.

    Applied to archives and listings before anything is opened, so a repository is read on its own route only.
    """
    return rows.join(routes.where(F.col("route") == route).select(*keys).distinct(), list(keys), "left_semi")


def limit_bytes(limit_mb: float | None = None) -> int:
    """The largest archive that still takes the archive route."""
    return int((limit_mb or DEFAULT_LIMIT_MB) * 1024 * 1024)

"""Language lookup: file path -> language, and which languages have splitter separators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# Detectable languages in table order; an entry starting with "." is an
# extension, any other entry is an exact file name. Comparison is
# case-insensitive and the first language in this order wins.
# ---------------------------------------------------------------------------
LANGUAGE_TABLE: dict[str, list[str]] = {
    "bash": [".sh", ".bash", ".zsh"],
    "c": [".c", ".h"],
    "cpp": [".cpp", ".cc", ".cxx", ".hpp", ".hh", ".hxx", ".C", ".H"],
    "c_sharp": [".cs", ".csx"],
    "css": [".css"],
    "go": [".go"],
    "html": [".html", ".htm"],
    "java": [".java"],
    "javascript": [".js", ".jsx", ".mjs", ".cjs"],
    "json": [".json"],
    "php": [".php", ".phtml"],
    "python": [".py", ".pyw"],
    "ruby": [".rb", ".rake", ".gemspec"],
    "rust": [".rs"],
    "typescript": [".ts", ".tsx"],
    "elixir": [".ex", ".exs"],
    "elm": [".elm"],
    "erlang": [".erl", ".hrl"],
    "fortran": [".f90", ".f95", ".f03"],
    "hack": [".hack", ".hhi"],
    "haskell": [".hs", ".lhs"],
    "hcl": [".hcl", ".tf"],
    "julia": [".jl"],
    "kotlin": [".kt", ".kts"],
    "lua": [".lua"],
    "make": ["Makefile", ".mk", ".make"],
    "markdown": [".md", ".markdown"],
    "ocaml": [".ml", ".mli"],
    "perl": [".pl", ".pm"],
    "ql": [".ql", ".qll"],
    "regex": [".regex"],
    "rst": [".rst"],
    "scala": [".scala", ".sc"],
    "sql": [".sql"],
    "toml": [".toml"],
    "yaml": [".yaml", ".yml"],
    "dockerfile": ["Dockerfile", ".dockerfile"],
    "elisp": [".el"],
    "objc": [".m", ".mm"],
    "swift": [".swift"],
    "vue": [".vue"],
    "svelte": [".svelte"],
}
# ---------------------------------------------------------------------------


def lookup_rows() -> list[tuple[str, str]]:
    """(lower-cased key, language) with the first language winning per key.

    Every extension holds exactly one dot and every exact name none, so the
    suffix-after-the-last-dot of a file's base name (or the whole base name
    when it has no dot) selects the same language as scanning the table.
    """
    seen: dict[str, str] = {}
    for lang, entries in LANGUAGE_TABLE.items():
        for e in entries:
            seen.setdefault(e.lower(), lang)
    return sorted(seen.items())


def language_lookup(spark: SparkSession) -> DataFrame:
    """The lookup as a tiny DataFrame (about 90 rows, fixed: safe to broadcast)."""
    return spark.createDataFrame(lookup_rows(), "lang_key string, language string")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def lang_key(path: Column) -> Column:
    """Lower-cased extension of the base name (".py"), or the whole base name if it has no dot."""
    name = base_name(path)
    return F.lower(
        F.when(name.contains("."), F.concat(F.lit("."), F.substring_index(name, ".", -1))).otherwise(name)
    )


def with_language(df: DataFrame, path_col: str = "file_path", out: str = "language",
                  how: str = "left") -> DataFrame:
    """Attach the detected language via a broadcast hash join on the fixed lookup.

    ``how='left'`` keeps unknown files (language 'unknown'); ``how='inner'`` keeps
    supported files only (filter F04 and detection P02 in one join).
    """
    spark = df.sparkSession
    lk = F.broadcast(language_lookup(spark).withColumnRenamed("language", out))
    keyed = df.withColumn("_lang_key", lang_key(F.col(path_col)))
    joined = keyed.join(lk, keyed["_lang_key"] == lk["lang_key"], how)
    if how == "left":
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit("unknown")))
    return joined.drop("_lang_key", "lang_key")


"""Scalar column expressions: paths, text tests, ids, names, URLs (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- paths -----------------------------------------------------------------

def clean_zip_path(entry: Column | str) -> Column:
    """Drop the archive's top folder: 'repo-abc/src/a.py' -> 'src/a.py'; no slash -> ''."""
    e = col(entry)
    return F.when(F.instr(e, "/") > 0, e.substr(F.instr(e, "/") + 1, F.lit(1 << 30))).otherwise(F.lit(""))


def is_directory(entry: Column | str) -> Column:
    return col(entry).endswith("/")


def is_hidden(path: Column | str) -> Column:
    """Hidden: any component starts with '.' (also true for '..' components)."""
    p = col(path)
    return p.contains("/.") | p.startswith(".")


# ---- text ------------------------------------------------------------------

def is_blank(text: Column | str) -> Column:
    """Null, empty or whitespace-only in Python's sense of whitespace."""
    t = col(text)
    return t.isNull() | ~t.rlike(P.NOT_BLANK)


def is_valid_utf8_bytes(raw: Column | str) -> Column:
    return F.is_valid_utf8(col(raw).cast("string"))


def size_class_chunk(text: Column | str, dynamic: bool = True, static_size: int = 1500) -> Column:
    """Chunk size by character length: <500 none, <2000 1000, <10000 1500, else 2000."""
    if not dynamic:
        return F.lit(static_size)
    n = F.length(col(text))
    return (F.when(n < 500, F.lit(None).cast("int"))
             .when(n < 2000, F.lit(1000))
             .when(n < 10000, F.lit(1500))
             .otherwise(F.lit(2000)))


def chunk_header(path: Column | str, text: Column | str) -> Column:
    return F.concat(F.lit("File: "), col(path), F.lit("\n\n"), col(text))


def non_ws_count(text: Column | str) -> Column:
    return F.length(F.regexp_replace(col(text), f"[{P.WS_CLASS_BODY}]", ""))


# ---- ids and names ---------------------------------------------------------

def chunk_id(repo_id, path, idx) -> Column:
    return F.concat(F.lit("repo_"), col(repo_id).cast("string"), F.lit("_"), col(path), F.lit("_"),
                    col(idx).cast("string"))


def code_doc_id(repo_id, path, idx) -> Column:
    """'{repo}_{basename with . -> _}_{i}_{md5('{repo}_{path}_{i}')[:10]}'."""
    r, p, i = col(repo_id).cast("string"), col(path), col(idx).cast("string")
    safe = F.translate(F.substring_index(p, "/", -1), ".", "_")
    digest = F.substring(F.md5(F.concat_ws("_", r, p, i)), 1, 10)
    return F.concat_ws("_", r, safe, i, digest)


def pr_doc_id(pr_number, repo_id) -> Column:
    """'{repo}_{n}_{md5('{repo}_{n}')[:8]}'."""
    r, n = col(repo_id).cast("string"), col(pr_number).cast("string")
    return F.concat_ws("_", r, n, F.substring(F.md5(F.concat_ws("_", r, n)), 1, 8))


def index_name(repo_name, branch, suffix: str) -> Column:
    """Repo '-' '.' -> '_', branch '/' '-' -> '_', then '_code' / '_pr'."""
    return F.concat(F.translate(col(repo_name), "-.", "__"), F.lit("_"),
                    F.translate(col(branch), "/-", "__"), F.lit(suffix))


def source_label(repo_name, branch) -> Column:
    return F.concat(col(repo_name), F.lit("@"), col(branch))


def blob_url(owner, repo_name, branch, path) -> Column:
    return F.concat(F.lit("https://github.com/"), col(owner), F.lit("/"), col(repo_name), F.lit("/blob/"),
                    col(branch), F.lit("/"), col(path))


def _first(pattern: str, text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, P.jvm(pattern), 1), F.lit(""))


def extract_class(text, language) -> Column:
    t, lang = col(text), col(language)
    return (F.when(lang == "python", _first(P.PY_CLASS, t))
             .when(lang.isin("javascript", "typescript"), _first(P.JS_CLASS, t))
             .when(lang.isin("java", "kotlin", "c_sharp"), _first(P.JAVA_CLASS, t))
             .when(lang == "rust", _first(P.RUST_STRUCT, t))
             .when(lang.isin("c", "cpp"), _first(P.C_CLASS, t)))


def extract_function(text, language) -> Column:
    t, lang = col(text), col(language)
    java_name = _first(P.JAVA_FUNC, t)
    return (F.when(lang == "python", _first(P.PY_FUNC, t))
             .when(lang.isin("javascript", "typescript"), _first(P.JS_FUNC, t))
             .when(lang.isin("java", "kotlin", "c_sharp"),
                   F.when(~java_name.isin(*P.JAVA_KEYWORDS), java_name))
             .when(lang == "go", _first(P.GO_FUNC, t))
             .when(lang == "rust", _first(P.RUST_FUNC, t))
             .when(lang.isin("c", "cpp"), _first(P.C_FUNC_FLAT, t)))


def name_metadata(class_name: Column, function_name: Column) -> Column:
    """map<string,string> holding only the names that were found ({} if none)."""
    m = F.create_map(F.lit("class_name"), class_name, F.lit("function_name"), function_name)
    return F.map_filter(m, lambda k, v: v.isNotNull())


def java_gate(text, language) -> Column:
    """Java method chunking applies: java, a class start, at least two signatures."""
    t = col(text)
    return ((F.lower(col(language)) == "java")
            & t.rlike(P.jvm(P.JAVA_CLASS_START))
            & (F.regexp_count(t, F.lit(P.jvm(P.JAVA_GATE_METHOD))) >= 2))


def java_signature_count(text) -> Column:
    return F.regexp_count(col(text), F.lit(P.jvm(P.JAVA_GATE_METHOD)))

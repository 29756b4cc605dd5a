"""code_documents (the rows-only flagship) against a brute-force Python pipeline on sf0.001.

The brute force walks the fixture rows one by one with Python's ``re`` and the
original pattern forms, scans the language table in order, and hashes ids with
hashlib: it shares only the two chunking helpers with the engine.
"""

import hashlib
import re

import duckdb
import pytest

from conftest import SF_SMALL
from codeindex.functions import patterns as P
from codeindex.functions.languages import LANGUAGE_TABLE
from codeindex.operators.chunking import pieces_for
from codeindex.session import TABLES
from codeindex.sources.fixtures import cte

M = re.MULTILINE


def detect(path):
    name = path.split("/")[-1]
    for lang, entries in LANGUAGE_TABLE.items():
        for e in entries:
            if e.startswith("."):
                if path.lower().endswith(e.lower()):
                    return lang
            elif name == e or name.lower() == e.lower():
                return lang
    return "unknown"


def names(text, lang):
    def first(p):
        m = re.search(p, text, M)
        return m.group(1) if m else None
    cls = fn = None
    if lang == "python":
        cls, fn = first(P.PY_CLASS), first(P.PY_FUNC)
    elif lang in ("javascript", "typescript"):
        cls, fn = first(P.JS_CLASS), first(P.JS_FUNC)
    elif lang in ("java", "kotlin", "c_sharp"):
        cls, fn = first(P.JAVA_CLASS), first(P.JAVA_FUNC)
        fn = None if fn in P.JAVA_KEYWORDS else fn
    elif lang == "go":
        fn = first(P.GO_FUNC)
    elif lang == "rust":
        cls, fn = first(P.RUST_STRUCT), first(P.RUST_FUNC)
    elif lang in ("c", "cpp"):
        cls, fn = first(P.C_CLASS), first(P.C_FUNC)
    return cls, fn


def size_for(text):
    n = len(text)
    return None if n < 500 else 1000 if n < 2000 else 1500 if n < 10000 else 2000


def brute_force_docs(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    entries = con.execute(cte("fx_archive_entries") + "SELECT repository_id, branch, entry, content FROM fx_archive_entries").fetchall()
    reqs = {(r[0], r[3]): r[1:] for r in con.execute(cte("fx_repo_requests") + "SELECT repository_id, owner, repo_name, branch FROM fx_repo_requests").fetchall()}
    out = set()
    for rid, on, entry, content in entries:
        if entry.endswith("/"):
            continue
        parts = entry.split("/")
        path = "/".join(parts[1:]) if len(parts) > 1 else ""
        if not path or "/." in path or path.startswith("."):
            continue
        lang = detect(path)
        if lang == "unknown" or (rid, on) not in reqs:
            continue
        if not content or not content.strip():
            continue
        owner, repo, branch = reqs[rid, on]
        gate = (lang.lower() == "java" and re.search(P.JAVA_CLASS_START, content, M)
                and len(re.findall(P.JAVA_GATE_METHOD, content, M)) >= 2)
        size = size_for(content)
        if gate:
            pieces = pieces_for(content, lang, "java", None)
        elif size is None:
            pieces = [content]
        else:
            pieces = pieces_for(content, lang, "split", size)
        for i, piece in enumerate(pieces):
            cls, fn = names(piece, lang)
            digest = hashlib.md5(f"{rid}_{path}_{i}".encode()).hexdigest()[:10]
            doc_id = f"{rid}_{path.split('/')[-1].replace('.', '_')}_{i}_{digest}"
            safe_repo = repo.replace("-", "_").replace(".", "_")
            safe_branch = branch.replace("/", "_").replace("-", "_")
            out.add((doc_id, f"File: {path}\n\n{piece}", lang, cls, fn,
                     f"https://github.com/{owner}/{repo}/blob/{branch}/{path}", f"{safe_repo}_{safe_branch}_code",
                     f"{repo}@{branch}"))
    return out


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_code_documents_match_brute_force(spark, sf):
    import __spark_entry__ as E
    got = E.queries()["code_documents"](spark, sf).collect()
    spark_rows = {(r.id, r.text, r.language, r.meta_class_name, r.meta_function_name, r.html_url, r.index_name,
                   r.source) for r in got}
    want = brute_force_docs(sf)
    assert len(got) == len(spark_rows)  # no duplicate documents
    assert spark_rows == want

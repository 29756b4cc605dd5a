"""SQL fragments for the DuckDB oracle that mirror the engine's column functions."""

from __future__ import annotations

from ..functions import patterns as P

lit = P.sql_literal

# ---------------------------------------------------------------------------
# The language of a lower-cased extension or file name, spelled out here once more so that the oracle does
# not read the engine's table.
# ---------------------------------------------------------------------------
LANGUAGES = """
WHEN k IN ('.sh', '.bash', '.zsh') THEN 'bash'
WHEN k IN ('.c', '.h') THEN 'c'
WHEN k IN ('.cpp', '.cc', '.cxx', '.hpp', '.hh', '.hxx') THEN 'cpp'
WHEN k IN ('.cs', '.csx') THEN 'c_sharp'
WHEN k IN ('.css') THEN 'css'
WHEN k IN ('.go') THEN 'go'
WHEN k IN ('.html', '.htm') THEN 'html'
WHEN k IN ('.java') THEN 'java'
WHEN k IN ('.js', '.jsx', '.mjs', '.cjs') THEN 'javascript'
WHEN k IN ('.json') THEN 'json'
WHEN k IN ('.php', '.phtml') THEN 'php'
WHEN k IN ('.py', '.pyw') THEN 'python'
WHEN k IN ('.rb', '.rake', '.gemspec') THEN 'ruby'
WHEN k IN ('.rs') THEN 'rust'
WHEN k IN ('.ts', '.tsx') THEN 'typescript'
WHEN k IN ('.ex', '.exs') THEN 'elixir'
WHEN k IN ('.elm') THEN 'elm'
WHEN k IN ('.erl', '.hrl') THEN 'erlang'
WHEN k IN ('.f90', '.f95', '.f03') THEN 'fortran'
WHEN k IN ('.hack', '.hhi') THEN 'hack'
WHEN k IN ('.hs', '.lhs') THEN 'haskell'
WHEN k IN ('.hcl', '.tf') THEN 'hcl'
WHEN k IN ('.jl') THEN 'julia'
WHEN k IN ('.kt', '.kts') THEN 'kotlin'
WHEN k IN ('.lua') THEN 'lua'
WHEN k IN ('makefile', '.mk', '.make') THEN 'make'
WHEN k IN ('.md', '.markdown') THEN 'markdown'
WHEN k IN ('.ml', '.mli') THEN 'ocaml'
WHEN k IN ('.pl', '.pm') THEN 'perl'
WHEN k IN ('.ql', '.qll') THEN 'ql'
WHEN k IN ('.regex') THEN 'regex'
WHEN k IN ('.rst') THEN 'rst'
WHEN k IN ('.scala', '.sc') THEN 'scala'
WHEN k IN ('.sql') THEN 'sql'
WHEN k IN ('.toml') THEN 'toml'
WHEN k IN ('.yaml', '.yml') THEN 'yaml'
WHEN k IN ('dockerfile', '.dockerfile') THEN 'dockerfile'
WHEN k IN ('.el') THEN 'elisp'
WHEN k IN ('.m', '.mm') THEN 'objc'
WHEN k IN ('.swift') THEN 'swift'
WHEN k IN ('.vue') THEN 'vue'
WHEN k IN ('.svelte') THEN 'svelte'
"""
# ---------------------------------------------------------------------------


def clean_path(e: str) -> str:
    return f"(CASE WHEN strpos({e}, '/') > 0 THEN substr({e}, strpos({e}, '/') + 1) ELSE '' END)"


def hidden(p: str) -> str:
    return f"(strpos({p}, '/.') > 0 OR starts_with({p}, '.'))"


def language(p: str) -> str:
    name = f"regexp_extract({p}, '[^/]*$', 0)"
    key = f"lower(CASE WHEN strpos({name}, '.') > 0 THEN regexp_extract({name}, '\\.[^.]*$', 0) ELSE {name} END)"
    return f"(SELECT CASE {LANGUAGES} ELSE 'unknown' END FROM (SELECT {key} AS k))"


def not_blank(t: str) -> str:
    return f"({t} IS NOT NULL AND regexp_matches({t}, {lit(P.NOT_BLANK)}))"


def py_strip(t: str) -> str:
    ws = P.WS_CLASS_BODY
    return f"regexp_replace({t}, {lit(f'^[{ws}]+|[{ws}]+$')}, '', 'g')"


def chunk_size(t: str) -> str:
    return (f"(CASE WHEN length({t}) < 500 THEN NULL WHEN length({t}) < 2000 THEN 1000 "
            f"WHEN length({t}) < 10000 THEN 1500 ELSE 2000 END)")


def rx_count(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, {lit(P.re2(pattern))}))"


def java_gate(t: str, lang: str) -> str:
    return (f"(lower({lang}) = 'java' AND regexp_matches({t}, {lit(P.re2(P.JAVA_CLASS_START))}) "
            f"AND {rx_count(t, P.JAVA_GATE_METHOD)} >= 2)")


def route(t: str, lang: str) -> str:
    return (f"(CASE WHEN NOT {not_blank(t)} THEN 'skip' WHEN {java_gate(t, lang)} THEN 'java' "
            f"WHEN length({t}) < 500 THEN 'whole' ELSE 'split' END)")


def first(pattern: str, t: str) -> str:
    return f"nullif(regexp_extract({t}, {lit(P.re2(pattern))}, 1), '')"


def extract_class(t: str, lang: str) -> str:
    return (f"(CASE WHEN {lang} = 'python' THEN {first(P.PY_CLASS, t)} "
            f"WHEN {lang} IN ('javascript', 'typescript') THEN {first(P.JS_CLASS, t)} "
            f"WHEN {lang} IN ('java', 'kotlin', 'c_sharp') THEN {first(P.JAVA_CLASS, t)} "
            f"WHEN {lang} = 'rust' THEN {first(P.RUST_STRUCT, t)} "
            f"WHEN {lang} IN ('c', 'cpp') THEN {first(P.C_CLASS, t)} END)")


def extract_function(t: str, lang: str) -> str:
    kw = ", ".join(lit(k) for k in P.JAVA_KEYWORDS)
    jf = first(P.JAVA_FUNC, t)
    return (f"(CASE WHEN {lang} = 'python' THEN {first(P.PY_FUNC, t)} "
            f"WHEN {lang} IN ('javascript', 'typescript') THEN {first(P.JS_FUNC, t)} "
            f"WHEN {lang} IN ('java', 'kotlin', 'c_sharp') THEN (CASE WHEN {jf} NOT IN ({kw}) THEN {jf} END) "
            f"WHEN {lang} = 'go' THEN {first(P.GO_FUNC, t)} "
            f"WHEN {lang} = 'rust' THEN {first(P.RUST_FUNC, t)} "
            f"WHEN {lang} IN ('c', 'cpp') THEN {first(P.C_FUNC, t)} END)")


def code_doc_id(repo: str, path: str, idx: str) -> str:
    r, i = f"CAST({repo} AS VARCHAR)", f"CAST({idx} AS VARCHAR)"
    base = f"replace(regexp_extract({path}, '[^/]*$', 0), '.', '_')"
    return f"concat_ws('_', {r}, {base}, {i}, substr(md5(concat_ws('_', {r}, {path}, {i})), 1, 10))"


def pr_doc_id(n: str, repo: str) -> str:
    r, s = f"CAST({repo} AS VARCHAR)", f"CAST({n} AS VARCHAR)"
    return f"concat_ws('_', {r}, {s}, substr(md5(concat_ws('_', {r}, {s})), 1, 8))"


def index_name(repo_name: str, branch: str, suffix: str) -> str:
    return f"concat(translate({repo_name}, '-.', '__'), '_', translate({branch}, '/-', '__'), '{suffix}')"


def epoch(ts: str) -> str:
    """ISO-8601 text -> epoch seconds (NULL when empty or malformed)."""
    return (f"(CASE WHEN regexp_matches({ts}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
            f"THEN CAST(floor(epoch(try_cast({ts} AS TIMESTAMPTZ))) AS BIGINT) END)")

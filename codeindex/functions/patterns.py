"""Regular expressions, written once and rendered for the JVM, RE2 and Python.

The fixed values below are Python ``re`` patterns applied in multi-line mode.
Python's ``\\s`` and ``\\w`` are Unicode-aware while Java's and RE2's are ASCII,
and Java's ``^`` also breaks on ``\\r``; :func:`jvm` and :func:`re2` rewrite the
shorthands into explicit classes so that Spark, DuckDB and Python agree.
"""

from __future__ import annotations

# Characters Python's str.isspace() / re ``\s`` treat as whitespace.
WS_CLASS_BODY = r"\t\n\x0b\x0c\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Python's ``\w``: letters, numbers, underscore.
WORD_CLASS_BODY = r"\p{L}\p{N}_"

# ---------------------------------------------------------------------------
# Name-extraction patterns (first match in the chunk text).
# ---------------------------------------------------------------------------
PY_CLASS = r"^class\s+(\w+)"
PY_FUNC = r"^(?:async\s+)?def\s+(\w+)"
JS_CLASS = r"^(?:export\s+)?class\s+(\w+)"
JS_FUNC = r"^(?:export\s+)?(?:async\s+)?function\s+(\w+)"
JAVA_CLASS = r"^(?:public\s+|private\s+|protected\s+)?(?:abstract\s+|final\s+|static\s+)?(?:class|interface|enum)\s+(\w+)"
JAVA_FUNC = r"^\s*(?:public|private|protected)\s+(?:static\s+)?(?:final\s+)?(?:synchronized\s+)?(?:[\w<>\[\],\s]+\s+)?(\w+)\s*\("
JAVA_KEYWORDS = ["return", "if", "else", "for", "while", "switch", "case", "try", "catch", "finally", "throw", "new"]
GO_FUNC = r"^func\s+(?:\(\w+\s+\*?\w+\)\s+)?(\w+)"
RUST_STRUCT = r"^(?:pub\s+)?struct\s+(\w+)"
RUST_FUNC = r"^(?:pub\s+)?fn\s+(\w+)"
C_CLASS = r"^(?:class|struct)\s+(\w+)"
C_FUNC = r"^(?:\w+\s+)+(\w+)\s*\([^)]*\)\s*\{"

# Java method chunking patterns.
JAVA_CLASS_START = r"^\s*(public\s+|private\s+|protected\s+)?(abstract\s+|final\s+|static\s+)?(class|interface|enum|record)\s+\w+"
JAVA_METHOD = r"^\s*(public|private|protected)\s+(?:static\s+)?(?:final\s+)?(?:synchronized\s+)?[\w<>\[\],\s]+\s+\w+\s*\([^)]*\)\s*(?:throws\s+[\w\s,]+)?\s*\{"
JAVA_GATE_METHOD = r"^\s*(public|private|protected)\s+(?:static\s+)?[\w<>\[\],\s]+\s+\w+\s*\("
# ---------------------------------------------------------------------------

# C_FUNC's repeated group recurses once per word in Java's engine and overflows the
# stack on long unpunctuated text.  The flat form accepts the same strings (a word
# character, then words and spaces, then whitespace before the captured name) and
# captures the same name, without a repeated group.
C_FUNC_FLAT = r"^\w[\w\s]*\s(\w+)\s*\([^)]*\)\s*\{"


def _rewrite(pattern: str) -> str:
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt in "sw":
                body = WS_CLASS_BODY if nxt == "s" else WORD_CLASS_BODY
                out.append(body if in_class else f"[{body}]")
            else:
                out.append(pattern[i:i + 2])
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def jvm(pattern: str) -> str:
    """Java regex: multi-line, ``^`` only after ``\\n``, Python classes."""
    return "(?md)" + _rewrite(pattern)


def re2(pattern: str) -> str:
    """RE2 / DuckDB regex with the same meaning."""
    return "(?m)" + _rewrite(pattern)


def sql_literal(s: str) -> str:
    """Quote a string for a SQL literal (single quotes doubled, no escapes needed)."""
    return "'" + s.replace("'", "''") + "'"


NOT_BLANK = f"[^{WS_CLASS_BODY}]"

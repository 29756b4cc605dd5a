"""Per-text helper: recursive, size-bounded splitting on language separators.

Contract: take the first separator that occurs in the text, cut before every
occurrence (the separator stays at the start of the following piece), merge
neighbouring pieces greedily while the merged length stays within ``size``,
re-split any piece of ``size`` or more with the separators after the chosen one,
down to single characters; strip every output piece and drop empty ones.
"""

from __future__ import annotations

import re
from functools import lru_cache

# ---------------------------------------------------------------------------
# Separator lists (regular expressions) per splitter language,
# tried in order; every list ends with "" (single characters).
# ---------------------------------------------------------------------------
_TAIL = ["\n\n", "\n", " ", ""]
SEPARATORS: dict[str, list[str]] = {
    "python": ["\nclass ", "\ndef ", "\n\tdef "] + _TAIL,
    "java": ["\nclass ", "\npublic ", "\nprotected ", "\nprivate ", "\nstatic ", "\nif ", "\nfor ",
             "\nwhile ", "\nswitch ", "\ncase "] + _TAIL,
    "kotlin": ["\nclass ", "\npublic ", "\nprotected ", "\nprivate ", "\ninternal ", "\ncompanion ",
               "\nfun ", "\nval ", "\nvar ", "\nif ", "\nfor ", "\nwhile ", "\nwhen ", "\ncase ",
               "\nelse "] + _TAIL,
    "javascript": ["\nfunction ", "\nconst ", "\nlet ", "\nvar ", "\nclass ", "\nif ", "\nfor ",
                   "\nwhile ", "\nswitch ", "\ncase ", "\ndefault "] + _TAIL,
    "typescript": ["\nenum ", "\ninterface ", "\nnamespace ", "\ntype ", "\nclass ", "\nfunction ",
                   "\nconst ", "\nlet ", "\nvar ", "\nif ", "\nfor ", "\nwhile ", "\nswitch ",
                   "\ncase ", "\ndefault "] + _TAIL,
    "go": ["\nfunc ", "\nvar ", "\nconst ", "\ntype ", "\nif ", "\nfor ", "\nswitch ", "\ncase "] + _TAIL,
    "cpp": ["\nclass ", "\nvoid ", "\nint ", "\nfloat ", "\ndouble ", "\nif ", "\nfor ", "\nwhile ",
            "\nswitch ", "\ncase "] + _TAIL,
    "c": ["\nclass ", "\nvoid ", "\nint ", "\nfloat ", "\ndouble ", "\nif ", "\nfor ", "\nwhile ",
          "\nswitch ", "\ncase "] + _TAIL,
    "c_sharp": ["\ninterface ", "\nenum ", "\nimplements ", "\ndelegate ", "\nevent ", "\nclass ",
                "\nabstract ", "\npublic ", "\nprotected ", "\nprivate ", "\nstatic ", "\nreturn ",
                "\nif ", "\ncontinue ", "\nfor ", "\nforeach ", "\nwhile ", "\nswitch ", "\nbreak ",
                "\ncase ", "\nelse ", "\ntry ", "\nthrow ", "\nfinally ", "\ncatch "] + _TAIL,
    "php": ["\nfunction ", "\nclass ", "\nif ", "\nforeach ", "\nwhile ", "\ndo ", "\nswitch ",
            "\ncase "] + _TAIL,
    "ruby": ["\ndef ", "\nclass ", "\nif ", "\nunless ", "\nwhile ", "\nfor ", "\ndo ", "\nbegin ",
             "\nrescue "] + _TAIL,
    "rust": ["\nfn ", "\nconst ", "\nlet ", "\nif ", "\nwhile ", "\nfor ", "\nloop ", "\nmatch "] + _TAIL,
    "scala": ["\nclass ", "\nobject ", "\ndef ", "\nval ", "\nvar ", "\nif ", "\nfor ", "\nwhile ",
              "\nmatch ", "\ncase "] + _TAIL,
    "swift": ["\nfunc ", "\nclass ", "\nstruct ", "\nenum ", "\nif ", "\nfor ", "\nwhile ", "\ndo ",
              "\nswitch ", "\ncase "] + _TAIL,
    "markdown": ["\n#{1,6} ", "```\n", "\n\\*\\*\\*+\n", "\n---+\n", "\n___+\n"] + _TAIL,
    "rst": ["\n=+\n", "\n-+\n", "\n\\*+\n", "\n\n.. *\n\n"] + _TAIL,
    "html": ["<body", "<div", "<p", "<br", "<li", "<h1", "<h2", "<h3", "<h4", "<h5", "<h6", "<span",
             "<table", "<tr", "<td", "<th", "<ul", "<ol", "<header", "<footer", "<nav", "<head",
             "<style", "<script", "<meta", "<title", ""],
    "lua": ["\nlocal ", "\nfunction ", "\nif ", "\nfor ", "\nwhile ", "\nrepeat "] + _TAIL,
    "perl": ["\nsub ", "\npackage ", "\nuse ", "\nif ", "\nunless ", "\nwhile ", "\nfor ",
             "\nforeach "] + _TAIL,
    "haskell": ["\nmain :: ", "\nmain = ", "\nlet ", "\nin ", "\ndo ", "\nwhere ", "\n:: ", "\n= ",
                "\ndata ", "\nnewtype ", "\ntype ", "\nmodule ", "\nimport ", "\nclass ",
                "\ninstance ", "\ncase "] + _TAIL,
    "elixir": ["\ndef ", "\ndefp ", "\ndefmodule ", "\ndefprotocol ", "\ndefmacro ", "\ndefmacrop ",
               "\nif ", "\nunless ", "\nwhile ", "\ncase ", "\ncond ", "\nwith ", "\nfor ",
               "\ndo "] + _TAIL,
}
GENERIC_SEPARATORS: list[str] = ["\n\n", "\n", " ", ""]
# ---------------------------------------------------------------------------


def separators_for(language: str | None) -> list[str]:
    return SEPARATORS.get((language or "").lower(), GENERIC_SEPARATORS)


@lru_cache(maxsize=512)
def _rx(sep: str) -> re.Pattern:
    return re.compile(sep)


def _cut(text: str, sep: str) -> list[str]:
    """Pieces of ``text`` cut before each occurrence of ``sep`` ('' = characters)."""
    if sep == "":
        return list(text)
    starts = [m.start() for m in _rx(sep).finditer(text) if m.end() > m.start()]
    bounds = [0] + starts + [len(text)]
    return [text[a:b] for a, b in zip(bounds, bounds[1:]) if b > a]


def _pack(pieces: list[str], size: int, out: list[str]) -> None:
    buf: list[str] = []
    filled = 0
    for p in pieces:
        if buf and filled + len(p) > size:
            _emit("".join(buf), out)
            buf, filled = [], 0
        buf.append(p)
        filled += len(p)
    if buf:
        _emit("".join(buf), out)


def _emit(text: str, out: list[str]) -> None:
    text = text.strip()
    if text:
        out.append(text)


def _split(text: str, seps: list[str], size: int, out: list[str]) -> None:
    chosen, rest = seps[-1], []
    for i, s in enumerate(seps):
        if s == "" or _rx(s).search(text):
            chosen, rest = s, (seps[i + 1:] if s != "" else [])
            break
    small: list[str] = []
    for piece in _cut(text, chosen):
        if len(piece) < size:
            small.append(piece)
            continue
        if small:
            _pack(small, size, out)
            small = []
        if rest:
            _split(piece, rest, size, out)
        else:
            _emit(piece, out)
    if small:
        _pack(small, size, out)


def split_text(text: str, size: int, separators: list[str] | None = None) -> list[str]:
    out: list[str] = []
    _split(text, separators if separators is not None else GENERIC_SEPARATORS, size, out)
    return out

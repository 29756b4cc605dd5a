"""Splitter contract: bounded pieces, order and visible characters preserved."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from codeindex.operators.splitter import GENERIC_SEPARATORS, SEPARATORS, split_text

WS = re.compile(r"\s+")


def visible(s: str) -> str:
    return "".join(ch for ch in s if not ch.isspace())


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list("ab c\n\tdef:()")), max_size=3000),
       size=st.sampled_from([5, 17, 100, 1000]),
       lang=st.sampled_from(["python", "java", "go", "markdown", "nope"]))
def test_invariants(text, size, lang):
    seps = SEPARATORS.get(lang, GENERIC_SEPARATORS)
    out = split_text(text, size, seps)
    assert all(0 < len(c) <= size for c in out)
    assert all(c == c.strip() for c in out)
    assert visible("".join(out)) == visible(text)


def test_separator_kept_at_start_of_next_piece():
    text = "def a():\n    pass\n\ndef b():\n    pass\n"
    out = split_text(text, 20, SEPARATORS["python"])
    assert out == ["def a():\n    pass", "def b():\n    pass"]


def test_greedy_merge():
    # the separator stays with the next piece and counts toward its length
    assert split_text("aa bb cc dd", 5) == ["aa bb", "cc", "dd"]

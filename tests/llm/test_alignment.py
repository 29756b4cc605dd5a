"""Operator 11 against the two libraries on whole texts and a plain walk over all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from codeindex.llm import alignment
from codeindex.llm.tokenizing import byte_characters
from llm_frames import frame  # noqa: F401  (a fixture)

ODD = ["", None, " ", "  ", "a", "a ", " a  b\n c", "it's  we'll\n\n\tgo ", "é中😀́x", "a\xa0 c　 d", "x\x1cy \x1f z", "<|endoftext|> <s> <0x41> <unk>", "▁x y",
       "antidisestablishmentarianism " * 40, "1234 56", "ﬀ" * 50, "\x00 b", "same words same words"]


@pytest.fixture(scope="module")
def files():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(P.path("piece_bpe_32k.model"), "rb") as g:
        return f.read(), g.read()


@pytest.fixture(scope="module")
def plain(files):
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(files[0])
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    byte = {c: b for b, c in byte_characters().items()}

    def one(text):
        if not text:
            return [], [], [], []
        a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        of_a = [bytes(byte[c] for c in t.id_to_token(x)) for x in a]
        of_b = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x) else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
        return (a, b, of_a, of_b) if b"".join(of_a) == b"".join(of_b) == (" " + text).encode() else ([], [], [], [])

    return one


def brute(plain, texts):
    docs, count = [], Counter()
    for text in texts:
        a, b, of_a, of_b = plain(text)
        ranges = []
        for parts in (of_a, of_b):
            at, own = 0, []
            for x in parts:
                own.append((at, at + len(x)))
                at += len(x)
            ranges.append(own)
        links = [(x, y) for x, (i, j) in zip(a, ranges[0], strict=True) for y, (k, m) in zip(b, ranges[1], strict=True) if max(i, k) < min(j, m)]
        ends = sorted({j for _, j in ranges[0]} & {j for _, j in ranges[1]})
        groups = []
        for low, high in zip([0, *ends], ends, strict=False):
            groups.append("|".join(",".join(str(x) for x, (i, j) in zip(ids, own, strict=True) if low <= i and j <= high)
                                   for ids, own in zip((a, b), ranges, strict=True)))
        docs.append((len(a), len(b), groups, links))
        count.update(set(links))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [(na, nb, len(g), len(x), sum(count[p] == top[p[0]] for p in x), sum(count[p] for p in x),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "", ";".join(g)) for na, nb, g, x in docs], count, top


@pytest.mark.parametrize("block,cache", [(16 << 20, 300_000), (60, 40)])
def test_equals_plain_walk(frame, files, plain, monkeypatch, block, cache):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "CACHE_PIECES", cache)
    alignment._PIECES.clear()
    random.seed(5)
    letters = "aeb 's't1  \n\t　é中%!'\x1c😀 İ▁"
    texts = ODD + ODD[4:7] + ["".join(random.choices(letters, k=random.randint(0, 30))) for _ in range(300)]
    want, count, top = brute(plain, texts)
    docs, links = alignment.align(frame(texts), "doc_id", "text", files[0], P.PATTERN, files[1], keep_groups=True)
    got = {r["id"]: tuple(r)[1:] for r in docs.collect()}
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, (texts[i], got[i], w)
    assert {((r["a"], r["b"]), r["n"], r["best"]) for r in links.collect()} == {(p, n, n == top[p[0]]) for p, n in count.items()}


def test_repeated_rows_null_ids_and_empty_table(frame, files, plain):
    texts = ["one two", "one two", None, "three two"]
    rows = alignment.align(frame(texts, [7, 7, None, None]), "doc_id", "text", files[0], P.PATTERN, files[1])[0].collect()
    want = brute(plain, texts)[0]
    assert sorted([(r["id"] or 0, *tuple(r)[1:8]) for r in rows]) == sorted([(i, *w[:7]) for i, w in zip([7, 7, 0, 0], want, strict=True)])
    docs, links = alignment.align(frame([]), "doc_id", "text", files[0], P.PATTERN, files[1])
    assert docs.count() == 0 and links.count() == 0


def test_a_long_text(frame, files, plain):
    text = "word " * 300_000 + "x" * 3000
    row = alignment.align(frame([text, "word"]), "doc_id", "text", files[0], P.PATTERN, files[1])[0].where("id = 0").first()
    a, b, _, _ = plain(text)
    assert (row["n_a"], row["n_b"]) == (len(a), len(b))


def test_slices_are_found_by_ends():
    a, b = np.array([1, 3, 6, 7, 10]), np.array([2, 3, 5, 6, 10])
    assert [x.tolist() for x in alignment.common_ends(a, b)] == [[3, 6, 10], [2, 3, 5], [2, 4, 5]]
    _, i, j = alignment.expand_links(a, b)
    assert list(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 0), (1, 0), (1, 1), (2, 2), (2, 3), (3, 4), (4, 4)]

"""Operators 1, 2 and 10 against the libraries and brute force."""

import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codeindex.llm import bpe, huffman_ids, queries, token_counts
from codeindex.llm.tokenizing import PieceEncoder, byte_level_json, merge_pairs, read_ranks
from llm_frames import frame  # noqa: F401  (a fixture)

ODD = ["", " ", "a", "it's  we'll\n\n\tgo ", "é中😀́x", "a  b　\xa0 c", "x\x1cy \x1f", "<|endoftext|> İΣ", "1234 56", "long " * 5000, "ﬀ" * 300]


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return read_ranks(f.read())


@pytest.fixture(scope="module")
def encoder(ranks):
    return PieceEncoder(byte_level_json(ranks, P.PATTERN), P.PATTERN, False)


@pytest.fixture(scope="module")
def oracle(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def split(encoder, texts):
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def test_merges_rebuild_every_token(ranks):
    assert len(merge_pairs(ranks)) == len(ranks) - 256


def test_ids_equal_the_rank_library(encoder, oracle):
    assert split(encoder, ODD) == [oracle(t) for t in ODD]
    letters = "ab 's't1  \n\t 　é中%!'\x1c\x85😀́ İ"
    random.seed(4)
    texts = ["".join(random.choices(letters, k=random.randint(0, 14))) for _ in range(5000)]
    assert split(encoder, texts) == [oracle(t) for t in texts]


def test_all_code_points(encoder, oracle):
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}{c} {c}b {c}1\n" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    assert split(encoder, texts) == [oracle(t) for t in texts]


def test_cache_restart_changes_nothing(ranks, oracle):
    small = PieceEncoder(byte_level_json(ranks, P.PATTERN), P.PATTERN, False, most=5)
    texts = [f"word{i} and more{i % 3}" for i in range(50)]
    assert [x for t in texts for x in split(small, [t])] == [oracle(t) for t in texts]


def test_encode_decode_in_spark(frame, oracle):
    texts = [*ODD, None]
    path = P.path("byte_bpe_50k.tiktoken")
    got = {r.id: r for r in bpe.decode(bpe.encode(frame(texts), "doc_id", "text", path, P.PATTERN), path).collect()}
    for i, t in enumerate(texts):
        assert list(got[i].ids) == oracle(t or "") and bytes(got[i].decoded) == (t or "").encode()
    assert bpe.encode(frame([]), "doc_id", "text", path, P.PATTERN).count() == 0


def test_character_ranges_cover_the_text(frame, ranks):
    token = {r: t for t, r in ranks.items()}
    for r in bpe.encode(frame(ODD), "doc_id", "text", P.path("byte_bpe_50k.tiktoken"), P.PATTERN, offsets=True).collect():
        text = ODD[r.id]
        for i, a, b in zip(r.ids, r.char_start, r.char_end, strict=True):
            assert token[i] in text[a:b].encode() and 0 <= a < b <= len(text)


def viterbi(word, scores, byte):
    """Plain dynamic programming over one word."""
    word = "▁" + word
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + n * byte, -(best[end - 1][1] + n))]
        for start in range(end):
            if word[start:end] in scores:
                options.append((scores[word[start:end]] + best[start][0], -(best[start][1] + 1)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_trie_counts_equal_plain_viterbi(frame):
    scores = token_counts.piece_scores(P.path("piece_bpe_32k.model"))
    texts = [*ODD[:-2], "Unbelievably internationalization", "été à Noël", None, "same same", "same same"]
    got = {r.id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(frame(texts), "doc_id", "text", P.path("piece_bpe_32k.model")).collect()}
    byte = min(scores.values())
    for i, t in enumerate(texts):
        words = [w for w in "".join(" " if c in "\t\n\v\f\r " else c for c in t or "").split(" ") if w]
        assert got[i] == (len(words), sum(viterbi(w, scores, byte) for w in words))


def test_trie_restart_changes_nothing(monkeypatch):
    scores = token_counts.piece_scores(P.path("piece_bpe_32k.model"))
    words = [f"wo{i}rd" for i in range(40)]
    plain = [token_counts.Trie(scores).count(w) for w in words]
    monkeypatch.setattr(token_counts, "TRIE_NODES", 10)
    trie = token_counts.Trie(scores)
    assert [trie.count(w) for w in words] == plain


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=3000))
def test_huffman_round_trip(ids):
    ids = np.array([i * i // 3000 for i in ids])
    counts = np.bincount(ids, minlength=3001)
    bits = huffman_ids.code_lengths(counts)
    codes = huffman_ids.canonical_codes(bits)
    assert bits.max() <= huffman_ids.MAX_BITS and sum(2.0 ** -int(b) for b in bits[bits > 0]) <= 1
    data, marks = huffman_ids.pack(ids, bits, codes)
    assert (huffman_ids.unpack(data, marks, len(ids), *huffman_ids.decode_table(bits, codes)) == ids).all()


def test_length_limit_holds_for_steep_counts():
    counts = np.array([1 << k for k in range(40)])
    bits = huffman_ids.code_lengths(counts)
    assert bits.max() == huffman_ids.MAX_BITS and abs(sum(2.0 ** -int(b) for b in bits) - 1) < 1e-12


def test_lengths_are_optimal_without_a_limit():
    import heapq

    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = rng.integers(1, 50, 60)
        heap = list(counts)
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            x = heapq.heappop(heap) + heapq.heappop(heap)
            cost += x
            heapq.heappush(heap, x)
        assert (huffman_ids.code_lengths(counts) * counts).sum() == cost


def test_file_round_trip_in_spark(frame):
    from tokenizers import Tokenizer

    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        js = f.read()
    t = Tokenizer.from_str(js)
    t.encode_special_tokens = True
    texts = [*ODD, None, "same", "same"]
    ids = [5, 3, 9, 1, 0, 2, 20, 11, 12, 13, 14, 30, 31, 32][: len(texts)]
    back = huffman_ids.round_trip(frame(texts, ids), "doc_id", "text", js, queries.split_pattern(js), True, 1, 49408, 3)
    start = 0
    got = {r.id: r for r in back.collect()}
    for k, text in sorted(zip(ids, texts, strict=True)):
        want = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert bytes(got[k].ids) == want.tobytes() and got[k].start == start
        start += len(want)
    empty = huffman_ids.round_trip(frame([]), "doc_id", "text", js, queries.split_pattern(js), True, 1, 49408, 3)
    assert empty.count() == 0


def test_queries_return_their_contracts(spark):
    sf = "/root/testdata/sf0.001"
    r = {x.doc_id: x for x in queries.op10_huffman_ids(spark, sf).collect()}
    assert sorted(r) == list(range(len(r))) and r[0].start == 0
    assert all(r[i + 1].start == r[i].start + r[i].n_tokens for i in range(len(r) - 1))
    assert queries.op1_byte_bpe(spark, sf).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 <= r[0].ids_crc32 < 1 << 32 and zlib.crc32(base64.b64decode("")) == 0


def thue_morse(n):
    """Two texts of n letters that polynomial hashes modulo 2**64 cannot tell apart (n from 1024)."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_pieces_of_equal_polynomial_hash_stay_apart(encoder, oracle, n):
    texts = list(thue_morse(n))
    assert split(encoder, texts) == [oracle(t) for t in texts]
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        js = f.read()
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(js)
    assert split(PieceEncoder(js, queries.split_pattern(js), True), texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]
    counter = token_counts.Counter({"▁a": -1.0, "bb": -1.5, "abb": -2.0, "a": -3.0, "b": -3.0})
    both = counter(pa.array(texts))[1].tolist()
    assert both == [token_counts.Counter(counter.trie.scores)(pa.array([x]))[1][0] for x in texts]


def test_hot_and_null_ids_keep_the_order(frame, monkeypatch):
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        js = f.read()
    ids = [None, None, *[7] * 300, *range(100)]
    texts = [f"word {i} " * (i % 5) for i in range(len(ids))]
    back = huffman_ids.round_trip(frame(texts, ids).repartition(5), "doc_id", "text", js, queries.split_pattern(js), True, 1, 49408, 4).collect()
    back.sort(key=lambda r: r.start)
    assert [r.id for r in back] == sorted(ids, key=lambda x: -1 if x is None else x)
    at = 0
    for r in back:
        assert r.start == at
        at += len(r.ids) // 4
    edges = huffman_ids.edges_of(frame(texts, ids).select("doc_id"), 16)
    assert (edges == 7).sum() > 5  # a hot id is dealt out


def test_segments_are_decoded_side_by_side():
    """Segments of any lengths, an empty one and single ids among them, come back from one call in order."""
    rng = np.random.default_rng(12)
    segments = [rng.zipf(1.4, n) % 3000 for n in (1, 511, 512, 513, 0, 5000, 1024)]
    bits = huffman_ids.code_lengths(np.bincount(np.concatenate(segments), minlength=3000))
    codes = huffman_ids.canonical_codes(bits)
    packed = [huffman_ids.pack(x, bits, codes) for x in segments]
    got = huffman_ids.unpack_all([d for d, _ in packed], [m for _, m in packed], [len(x) for x in segments], *huffman_ids.decode_table(bits, codes))
    assert (got == np.concatenate(segments)).all()

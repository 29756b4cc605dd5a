"""Cached piecewise encoding with the tokenizers library, and its rank-file loader.

White space that follows a non-space always starts a new pre-token in the public vocabularies used here, so a
text's ids are the ids of its pieces (a white-space run with the run of other characters behind it, or the marks behind
an ASCII letter, where every such vocabulary starts anew as well) one after another. Words repeat, so each worker keeps the ids of the pieces it has met; the library encodes the new ones.
Pieces are found by a hash and compared byte by byte.
"""

from __future__ import annotations

import base64
import gc
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import Known, distinct, ragged, text_buffer

# Separators beyond ASCII white space, or that only some libraries take as white space: such texts go in whole.
ODD_SPACE = "[\x1c-\x1f\u0085\u00a0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
# Pieces kept by a worker (about 60 bytes each), the bytes of their texts, and parts of pieces (about 250 bytes each);
# a cache starts anew when full, which bounds its memory and changes no result.
CACHE_PIECES = 400_000
CACHE_BYTES = 32 << 20
CACHE_PARTS = 100_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank in each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    out.update({b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in out)})
    return out


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """For each token of two bytes or more, the two parts that its bytes reach by merges of lower rank."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) < 2:
            continue
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                        if ranks.get(a + b, rank) < rank), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def byte_level_json(ranks: dict[bytes, int], pattern: str) -> str:
    """The rank file as a byte-level BPE of the tokenizers library (its JSON form)."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_characters()
    name = lambda b: "".join(shown[x] for x in b)
    model = models.BPE(vocab={name(t): r for t, r in ranks.items()},
                       merges=[(name(a), name(b)) for a, b in merge_pairs(ranks)], ignore_merges=True)
    t = Tokenizer(model)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"),
                                               pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return t.to_str()


class PieceEncoder:
    """Flat ids of an Arrow string array, with a bounded cache of pieces.

    ``pattern`` is the vocabulary's split pattern in the syntax of the regex module and ``lower`` tells if it
    folds case. Pieces of Latin characters are split by it here and only their parts go to the library's model;
    all others go through the complete tokenizer.
    """

    def __init__(self, tokenizer_json: str, pattern: str, lower: bool, most: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.find = regex.compile(pattern).findall
        self.plain = regex.compile("[\t\n\r -~\u00a1-\u012f\u0131-\u017f]*").fullmatch
        self.shown = {chr(c): "".join(byte_characters()[b] for b in chr(c).encode()) for c in range(0x180)}
        self.table = str.maketrans(self.shown)
        self.lower, self.most = lower, most
        self._reset()

    def _reset(self) -> None:
        self.parts: dict[str, list[int]] = {}
        self.known = Known()
        # ids of the known pieces, and where those of each slot lie
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def ids_of(self, piece: str) -> list[int]:
        plain = piece.isascii()
        if plain or self.plain(piece):
            # a word, perhaps with marks behind it: the pattern leaves the word and the run of marks whole
            core = piece.rstrip(".,;:!?")
            spaced = core[:1] == " "
            word = core[1:] if spaced else core
            if word.isalpha():
                if self.lower:
                    ids = self._part(word.lower(), plain)
                elif spaced and plain:
                    ids = self._part(core, True, self.shown[" "] + word)
                else:
                    ids = self._part(core, plain and not spaced)
                return ids if len(core) == len(piece) else ids + self._part(piece[len(core):], True)
        else:
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        parts = self.find(piece.lower() if self.lower else piece)
        if len(parts) == 1:
            return self._part(parts[0])
        out: list[int] = []
        for part in parts:
            out += self._part(part)
        return out

    def _part(self, part: str, visible: bool = False, shown: str | None = None) -> list[int]:
        """Ids of what the pattern leaves whole; ``visible``: every character stands for itself, or ``shown`` does for all."""
        ids = self.parts.get(part)
        if ids is None:
            if shown is None:
                shown = part if visible or part.isascii() and part.isprintable() and " " not in part else part.translate(self.table)
            ids = self.parts[part] = [t.id for t in self.model.tokenize(shown)]
        return ids

    def _append(self, names: list[bytes]) -> None:
        """Encode ``names`` as the next slots."""
        if len(self.parts) > CACHE_PARTS:
            self.parts = {}
        gc.disable()  # nothing below makes cycles, and each collection would walk all cached parts
        try:
            found = [self.ids_of(x.decode("utf-8", "replace")) for x in names]
        finally:
            gc.enable()
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        need = self.used + int(lengths.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(need, len(self.flat) // 2), np.uint32)])
        self.flat[self.used:need] = np.fromiter(chain.from_iterable(found), np.uint32, need - self.used)
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used = need

    def _slots(self, names: pa.Array) -> np.ndarray:
        """Where the ids of the pieces ``names`` (all different) lie."""
        if len(self.known) and (len(self.known) + len(names) > self.most or self.known.held > CACHE_BYTES):
            self._reset()
        slot = self.known.find(names)
        fresh = np.flatnonzero(slot < 0)
        if len(fresh):
            new = names.take(pa.array(fresh))
            added = self.known.add(new)
            base, some = len(self.known) - len(added), new.to_pylist()
            self._append([some[i] for i in added.tolist()])
            slot[fresh[added]] = base + np.arange(len(added))
            rest = np.flatnonzero(slot < 0)
            if len(rest):  # another piece has their hash: they take slots for this call only
                keep = self.used, len(self.starts)
                self._append(names.take(pa.array(rest)).to_pylist())
                slot[rest] = keep[1] + np.arange(len(rest))
                self.spare = keep
        return slot

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty) one after another, and the n+1 offsets of the texts in them."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        buf, offsets = text_buffer(texts)
        if not len(buf):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        space = _SPACE[buf]
        begin = np.zeros(len(buf) + 1, bool)
        begin[1:-1] = space[1:] & ~space[:-1] | _MARK[buf[1:]] & _LETTER[buf[:-1]]
        odd = np.asarray(pc.match_substring_regex(texts, ODD_SPACE))
        for i in np.flatnonzero(odd):
            begin[offsets[i]:offsets[i + 1]] = False
        begin[offsets] = True
        begin[-1] = False
        starts = np.flatnonzero(begin)
        names, which = distinct(buf, np.append(starts, len(buf)))
        self.spare = None
        slot = self._slots(names)[which]
        lengths = self.lengths[slot]
        ids = ragged(self.flat, self.starts[slot], lengths)
        if self.spare is not None:
            self.used, n = self.spare
            self.starts, self.lengths = self.starts[:n], self.lengths[:n]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, total[np.searchsorted(starts, offsets)]


_ENCODERS: dict[tuple, PieceEncoder] = {}


def worker_encoder(tokenizer_json: str, pattern: str, lower: bool) -> PieceEncoder:
    """The encoder of this Python worker; it outlives a task, so the next one starts with its cache."""
    key = (hash(tokenizer_json), pattern, lower)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(tokenizer_json, pattern, lower)
    return _ENCODERS[key]

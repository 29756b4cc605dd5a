"""Token counts of whole texts under a unigram model (operator 2): dynamic programming shared over a trie.

A pre-token is a maximal run of bytes other than ASCII white space, written with a leading U+2581. Its token count
is the number of pieces in its best segmentation: the sum of the pieces' log-probabilities is largest, and among
equal sums the fewest pieces win. Piece probabilities follow the Zipf-Mandelbrot law over the ranks of a public
vocabulary. A character that the vocabulary lacks costs one byte token (of the lowest probability) per UTF-8 byte.

Each worker inserts the distinct pre-tokens it meets in a trie. A node holds the best score and count of the prefix
it stands for, computed once from the nodes above it, whichever and however many pre-tokens share that prefix; the
count at a pre-token's last node is its token count. Known terminal counts are looked up by the pre-token's bytes, once
for each different one of a slice. Nothing is shuffled: counts depend on the text alone.

Null texts count as empty (0, 0). Rows are independent of each other, so ties and repeats need no rule; an empty table
gives an empty one, a text of any length is one slice, and other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Known, distinct, prepare, slices, text_buffer

# A worker's trie and terminal table start anew beyond these sizes: bounded memory, same results.
TRIE_NODES = 300_000
KNOWN_WORDS = 1_500_000
KNOWN_BYTES = 64 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def piece_scores(model_path: str) -> dict[str, float]:
    """Log-probability of each ordinary piece of a sentencepiece file, by its rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / (r + 2.7) for r in range(len(pieces))))
    out: dict[str, float] = {}
    for r, p in enumerate(pieces):
        out.setdefault(p, -math.log(r + 2.7) - total)
    return out


class Trie:
    """Forward scores and counts of prefixes; ``count`` inserts a pre-token and returns its terminal count."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.lengths = sorted({len(p) for p in scores})
        self.byte = min(scores.values(), default=0.0)
        self._reset()

    def _reset(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.number = [0.0], [0]

    def count(self, word: str) -> int:
        if len(self.best) > TRIE_NODES:
            self._reset()
        word = "▁" + word
        child, best, number, scores = self.child, self.best, self.number, self.scores
        node, path = 0, [0]
        for end, char in enumerate(word, 1):
            below = child.get((node, char))
            if below is None:
                below = child[node, char] = len(best)
                n = len(char.encode("utf-8", "replace"))
                top, fewest = best[path[-1]] + n * self.byte, number[path[-1]] + n
                for size in self.lengths:
                    if size > end:
                        break
                    score = scores.get(word[end - size:end])
                    if score is not None:
                        above = path[end - size]
                        score += best[above]
                        if score > top or score == top and number[above] + 1 < fewest:
                            top, fewest = score, number[above] + 1
                best.append(top)
                number.append(fewest)
            path.append(below)
            node = below
        return number[node]


class Counter:
    """Token counts of Arrow texts, with the terminal counts of the pre-tokens met so far."""

    def __init__(self, scores: dict[str, float]):
        self.trie = Trie(scores)
        self.known, self.counts = Known(), np.empty(0, np.int64)

    def _counts(self, names: pa.Array) -> np.ndarray:
        if len(self.known) + len(names) > KNOWN_WORDS or self.known.held > KNOWN_BYTES:
            self.known, self.counts = Known(), np.empty(0, np.int64)
        slot = self.known.find(names)
        out = np.zeros(len(names), np.int64)
        out[slot >= 0] = self.counts[slot[slot >= 0]]
        fresh = np.flatnonzero(slot < 0)
        if len(fresh):
            new = names.take(pa.array(fresh))
            out[fresh] = [self.trie.count(x.decode("utf-8", "replace")) for x in new.to_pylist()]
            self.counts = np.concatenate([self.counts, out[fresh[self.known.add(new)]]])
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        buf, offsets = text_buffer(texts)
        n = len(offsets) - 1
        if not len(buf):
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        inside = ~_SPACE[buf]
        cut = np.zeros(len(buf) + 1, bool)
        cut[offsets] = True
        begin, finish = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1] | cut[1:-1]
        finish[:-1] &= ~inside[1:] | cut[1:-1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        row = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.diff(row), np.zeros(n, np.int64)
        # words and the gaps between them take turns
        cuts = np.empty(2 * len(starts), np.int64)
        cuts[::2], cuts[1::2] = starts, ends
        names, which = distinct(buf, cuts)
        which = which[::2]
        found = np.zeros(len(names), np.int64)
        found[which] = 1
        words = np.flatnonzero(found)
        found[words] = self._counts(names.take(pa.array(words)))
        each = found[which]
        total = np.concatenate([[0], np.cumsum(each)])
        return np.diff(row), total[row[1:]] - total[row[:-1]]


_COUNTERS: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, id_col: str, text_col: str, model_path: str) -> DataFrame:
    """(id, n_pretokens long, n_tokens long) of each row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(piece_scores(model_path))  # one entry per piece of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = shared.value
        key = hash((len(scores), sum(scores.values())))
        if key not in _COUNTERS:  # kept by the worker from task to task
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(scores)
        for b in slices(batches, "text"):
            words, tokens = _COUNTERS[key](b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(words), pa.array(tokens)], ["id", "n_pretokens", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_pretokens long, n_tokens long")

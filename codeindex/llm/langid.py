"""Language identification of whole, possibly mixed texts (operator 3).

Training counts hashed byte n-grams (one to three bytes, word ends marked) and scripts of each language. A word's
score in a language is the sum of the smoothed log-probabilities of its n-grams. Script ranges narrow a word's
candidates to the languages that were seen in its script. A Viterbi search with a switching penalty then labels
every word of a text, so that runs of one language form spans.

* prediction: the language of most labelled words (ties: the smaller name); score: its share of them.
* ``und`` (score 0): null text, no letter, or nothing learned. A text with letters in scripts that no language was
  seen in gets the language of most training rows, score 0.

Training reads at most ``MAX_TRAIN_ROWS`` labelled rows per language (chosen by a hash, so any row may be among
them); beyond that bound more rows no longer change n-gram frequencies notably. Rows without text or label are left
out. Prediction sees the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, prepare, slices, text_buffer, word_spans

MAX_TRAIN_ROWS = 4000
BUCKETS = 1 << 16
SWITCH = 12.0
BLOCK = 64
# A language counts as written in a script that holds this share of its training words.
SCRIPT_SHARE = 0.02

# Script of a word by the first byte of its first letter; three-byte characters by their second byte as well.
SCRIPTS = ["none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "cjk", "kana", "hangul", "other"]
_FIRST = np.zeros(256, np.uint8)
_FIRST[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCD)]] = 1
_FIRST[[0xCE, 0xCF]] = 2
_FIRST[[0xD0, 0xD1, 0xD2, 0xD3]] = 3
_FIRST[0xD4] = _FIRST[0xD5] = 4
_FIRST[[0xD6, 0xD7]] = 5
_FIRST[[0xD8, 0xD9, 0xDA, 0xDB]] = 6
_FIRST[[0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9]] = 9
_FIRST[[0xEA, 0xEB, 0xEC, 0xED]] = 11
_FIRST[[0xDC, 0xDD, 0xDE, 0xDF, 0xE1, 0xEF, 0xF0]] = 12


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts, ends, scripts and each row's first word. Digits alone have script 0."""
    # two spaces behind each text keep its n-grams apart from the next one's
    padded = pc.binary_join_element_wise(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())), pa.scalar("  ", pa.large_string()), pa.scalar("", pa.large_string()))
    buf, offsets = text_buffer(padded)
    starts, ends, first = word_spans(buf, offsets)
    if not len(starts):
        return buf, starts, ends, np.empty(0, np.uint8), first
    kind = _FIRST[buf]
    indic = (buf == 0xE0)
    nxt = np.append(buf[1:], 0)
    kind = np.where(indic, np.where((nxt >= 0xB8) & (nxt <= 0xBB), 8, 7), kind)
    kind = np.where((buf == 0xE3) & (nxt >= 0x81) & (nxt <= 0x83), 10, np.where(buf == 0xE3, 9, kind)).astype(np.uint8)
    # a word's script is that of its first letter: the first position with a script at or after its start
    lettered = np.flatnonzero(kind)
    at = np.searchsorted(lettered, starts)
    pos = np.append(lettered, len(buf))[at]
    script = np.where(pos < ends, kind[np.minimum(pos, len(buf) - 1)], 0).astype(np.uint8)
    return buf, starts, ends, script, first


def grams(buf: np.ndarray, inside: np.ndarray) -> list[np.ndarray]:
    """For every byte, the buckets of the n-grams of 1, 2 and 3 bytes that end there; bytes outside words read as 32."""
    b = np.where(inside, buf, 32).astype(np.uint32)
    b1 = np.concatenate([[32], b[:-1]]).astype(np.uint32)
    b2 = np.concatenate([[32, 32], b[:-2]]).astype(np.uint32)[: len(b)]
    out = []
    for x, salt in ((b, 1), (b1 << 8 | b, 2), (b2 << 16 | b1 << 8 | b, 3)):
        h = (x + np.uint32(salt << 24)) * np.uint32(0x9E3779B1)
        out.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(16))
    return out


def _inside(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    step = np.zeros(n + 1, np.int8)
    step[starts] += 1
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


class Model:
    """Languages, the log-probability of each bucket in each language, and the scripts of each language."""

    def __init__(self, langs: list[str], rows: list[int], counts: np.ndarray, scripts: np.ndarray):
        self.langs, self.rows = langs, rows
        smooth = counts + 0.1
        self.logp = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32).T.copy() if langs else np.zeros((BUCKETS, 0), np.float32)
        total = np.maximum(1, scripts[:, 1:].sum(axis=1, keepdims=True)) if langs else 1
        self.allowed = (scripts / total >= SCRIPT_SHARE).T.copy() if langs else np.zeros((len(SCRIPTS), 0), bool)
        self.allowed[0] = False

    def word_scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Score of every word in every language (0 for words without candidates), whether it has any, and places."""
        buf, starts, ends, script, first = words_of(texts)
        n = len(self.langs)
        if not len(starts) or not n:
            return np.zeros((len(starts), n)), np.zeros(len(starts), bool), starts, ends, first
        inside = _inside(len(buf), starts, ends)
        gs = grams(buf, inside)
        scores = np.empty((len(starts), n))
        for k in range(n):
            column = np.ascontiguousarray(self.logp[:, k])
            total = np.zeros(len(buf) + 1)
            np.cumsum(column[gs[0]] + column[gs[1]] + column[gs[2]], out=total[1:], dtype=np.float64)
            # the byte behind a word closes its last n-grams
            scores[:, k] = total[np.minimum(ends + 1, len(buf))] - total[starts]
        allowed = self.allowed[script]
        known = allowed.any(axis=1)
        scores = np.where(allowed, scores, -1e6)
        scores[~known] = 0
        return scores, known, starts, ends, first


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word, each row by itself; moving to another label costs ``switch``. Ties: the smaller label.

    Rows are cut in blocks of BLOCK words. One pass over all blocks at once finds, for each label at a block's entry,
    the best score of each label at its end; a pass over the blocks of each row picks the labels at the block ends;
    a last pass, again over all blocks at once, labels the words between them.
    """
    words, n = scores.shape
    if not words or not n:
        return np.zeros(words, np.int64)
    if n == 1:
        return np.zeros(words, np.int64)
    count = np.diff(first)
    blocks = -(-count // BLOCK)
    total = int(blocks.sum())
    row_first = np.concatenate([[0], np.cumsum(blocks)])
    row = np.repeat(np.arange(len(count)), blocks)
    start = first[:-1][row] + (np.arange(total) - row_first[:-1][row]) * BLOCK
    size = np.minimum(BLOCK, first[1:][row] - start)

    def emit(k: int) -> np.ndarray:
        """Scores of the k-th word of each block, 0 behind its end."""
        return np.where((k < size)[:, None], scores[np.minimum(start + k, words - 1)], 0.0)

    def moved(v: np.ndarray) -> np.ndarray:
        return np.maximum(v, v.max(axis=-1, keepdims=True) - switch)

    # reach[b, i, j]: best score inside block b that comes from label i before it and ends in label j
    reach = np.where(np.eye(n, dtype=bool), 0.0, -switch) + emit(0)[:, None, :]
    reach = np.broadcast_to(reach, (total, n, n)).copy()
    for k in range(1, BLOCK):
        live = k < size
        if not live.any():
            break
        step = moved(reach) + emit(k)[:, None, :]
        reach = np.where(live[:, None, None], step, reach)
    # row level: the same recursion over blocks (a row's first block is entered for free from any label)
    score = np.zeros((len(count), n))
    came = np.zeros((total, n), np.int64)
    for k in range(int(blocks.max())):
        rows = np.flatnonzero(blocks > k)
        b = row_first[rows] + k
        options = score[rows][:, :, None] + reach[b]
        came[b] = options.argmax(axis=1)
        score[rows] = options.max(axis=1)
    leave = np.zeros(total, np.int64)
    enter = np.zeros(total, np.int64)
    label = score.argmax(axis=1)
    for k in range(int(blocks.max()) - 1, -1, -1):
        rows = np.flatnonzero(blocks > k)
        b = row_first[rows] + k
        leave[b] = label[rows]
        enter[b] = came[b, label[rows]]
        label[rows] = enter[b]
    # word level, with the labels at both ends of each block known
    v = np.where(np.arange(n) == enter[:, None], 0.0, -switch) + emit(0)
    back = np.zeros((BLOCK, total, n), np.uint8)
    for k in range(1, BLOCK):
        live = k < size
        if not live.any():
            break
        top = v.argmax(axis=1)
        jump = v[np.arange(total), top] - switch
        stay = v >= jump[:, None]
        back[k] = np.where(stay, np.arange(n), top[:, None])
        v = np.where(live[:, None], np.where(stay, v, jump[:, None]) + emit(k), v)
    out = np.zeros(words, np.int64)
    label = leave.copy()
    for k in range(BLOCK - 1, -1, -1):
        live = np.flatnonzero(k < size)
        if len(live):
            out[start[live] + k] = label[live]
            if k:
                label[live] = back[k, live, label[live]]
    return out


def fit(labelled: DataFrame, text_col: str, lang_col: str, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Learn from (text, lang) rows; at most about ``max_rows`` rows of each language take part."""
    prepare(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    # a language's rows: one number per language
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], [], np.zeros((0, BUCKETS)), np.zeros((0, len(SCRIPTS))))
    keep = F.lit(False)
    for lang, n in sizes.items():
        share = int(min(1.0, max_rows / n) * (1 << 20))
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share))
    index = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(index), BUCKETS + len(SCRIPTS)), np.int64)
        for b in slices(batches, "text"):
            names = np.array([index[x] for x in b.column("lang").to_pylist()])
            for i in np.unique(names):
                buf, starts, ends, script, _ = words_of(b.column("text").filter(pa.array(names == i)))
                if not len(starts):
                    continue
                inside = _inside(len(buf), starts, ends)
                inside_or_end = inside.copy()
                inside_or_end[1:] |= inside[:-1]
                for g in grams(buf, inside):
                    counts[i, :BUCKETS] += np.bincount(g[inside_or_end], minlength=BUCKETS)
                counts[i, BUCKETS:] += np.bincount(script, minlength=len(SCRIPTS))
        i, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(counts[i, slot])], ["lang", "slot", "n"])

    total = np.zeros((len(langs), BUCKETS + len(SCRIPTS)))
    # at most BUCKETS + 13 rows per language
    got = rows.where(keep).mapInArrow(run, "lang int, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    total[got["lang"].to_numpy(), got["slot"].to_numpy()] = got["n"].to_numpy()
    return Model(langs, [sizes[x] for x in langs], total[:, :BUCKETS], total[:, BUCKETS:])


def predict(docs: DataFrame, id_col: str, text_col: str, model: Model, spans: bool = False) -> DataFrame:
    """(id, lang_pred, score), with ``spans`` array<struct<lang, start, end>> in characters of the lower-cased text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats
    more = ", spans array<struct<lang:string,start:int,end:int>>" if spans else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        langs = model.langs
        # the passes over a slice hold languages x languages numbers per block of words
        for b in slices(batches, "text", max(1 << 14, SLICE_BYTES // 2 * 400 // max(400, len(langs) ** 2))):
            texts = pc.fill_null(b.column("text"), "")
            scores, known, starts, ends, first = model.word_scores(texts)
            label = viterbi(scores, first)
            n = b.num_rows
            row = np.repeat(np.arange(n), np.diff(first))
            votes = np.bincount(row[known] * max(1, len(langs)) + label[known], minlength=n * max(1, len(langs))).reshape(n, -1)
            total = votes.sum(axis=1)
            best = votes.argmax(axis=1)
            score = votes.max(axis=1) / np.maximum(total, 1)
            lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}"))
            usual = int(np.argmax(model.rows)) if langs else 0
            best = np.where(total > 0, best, usual)
            named = [langs[k] if ok and langs else "und" for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
            out = [b.column("id"), pa.array(named), pa.array(np.where(lettered, score, 0.0))]
            if spans:
                out.append(pa.array(_spans(texts, label, known, starts, ends, first, langs),
                                    pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(out, ["id", "lang_pred", "score", *["spans"] * spans])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double{more}")


def _spans(texts, label, known, starts, ends, first, langs) -> list[list[dict]]:
    buf, _, _, _, _ = words_of(texts)
    offsets = text_buffer(pc.utf8_lower(texts.cast(pa.large_string())))[1] + 2 * np.arange(len(first))
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    out = []
    for i in range(len(offsets) - 1):
        w = np.flatnonzero(known[first[i]:first[i + 1]]) + first[i]
        cuts = np.flatnonzero(np.concatenate([[True], label[w][1:] != label[w][:-1], [True]])) if len(w) else []
        out.append([{"lang": langs[label[w[a]]], "start": int(lead[starts[w[a]]] - lead[offsets[i]]),
                     "end": int(lead[ends[w[z - 1]]] - lead[offsets[i]])} for a, z in zip(cuts[:-1], cuts[1:], strict=True)])
    return out


def held_out(id_col: Column) -> Column:
    """Rows that training must not see: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))

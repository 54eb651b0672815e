"""Language identification of mixed text: script ranges, per-word scores, and a Viterbi pass with a switching penalty.

Learning counts, over all training rows, hashed character trigrams of words for each language, and the scripts that
a language's words are written in. A word's script narrows its candidate languages; its score for a candidate is the
mean log share of its trigrams. The Viterbi pass labels every word of a text so that the sum of scores, less a
penalty for each change of language, is largest. The text's language has the most letters under its label.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Trigrams fall into 2**GRAM_BITS counters, which bounds the model.
GRAM_BITS = 15
#: Weight of a word's mean log trigram share, cost of a change of language, count added to each counter.
WEIGHT, SWITCH, PRIOR = 3.0, 6.0, 0.5
#: A language is a candidate for a script that at least this share of its training words is written in.
SCRIPT_SHARE = 0.001
#: Tokens that are labelled together.
BLOCK = 250_000

# First code point of a range and the script of its letters ("" where none of those listed).
SCRIPT_RANGES = [
    (0x0, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xAA, "latin"), (0x2B0, ""), (0x370, "greek"), (0x400, "cyrillic"),
    (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "syriac"), (0x750, "arabic"), (0x780, "thaana"), (0x7C0, "nko"), (0x800, ""),
    (0x8A0, "arabic"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "gurmukhi"), (0xA80, "gujarati"), (0xB00, "oriya"), (0xB80, "tamil"),
    (0xC00, "telugu"), (0xC80, "kannada"), (0xD00, "malayalam"), (0xD80, "sinhala"), (0xE00, "thai"), (0xE80, "lao"), (0xF00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, "canadian"), (0x1680, ""),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x2C60, "latin"), (0x2C80, "coptic"),
    (0x2D00, "georgian"), (0x2D30, "tifinagh"), (0x2D80, "ethiopic"), (0x2DE0, "cyrillic"), (0x2E00, ""), (0x3040, "kana"), (0x3100, "bopomofo"),
    (0x3130, "hangul"), (0x3190, ""), (0x31F0, "kana"), (0x3200, ""), (0x3400, "han"), (0x4DC0, ""), (0x4E00, "han"), (0xA000, "yi"), (0xA4D0, ""),
    (0xA640, "cyrillic"), (0xA6A0, ""), (0xA720, "latin"), (0xA800, ""), (0xA8E0, "devanagari"), (0xA900, ""), (0xA960, "hangul"), (0xA980, ""),
    (0xAA60, "myanmar"), (0xAA80, ""), (0xAC00, "hangul"), (0xD800, ""), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, ""), (0xFE70, "arabic"), (0xFF00, ""), (0xFF21, "latin"), (0xFF3B, ""), (0xFF41, "latin"), (0xFF5B, ""),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, ""), (0x20000, "han"), (0x32000, ""),
]
SCRIPT_STARTS = [first for first, _ in SCRIPT_RANGES]
SCRIPT_NAMES = sorted({name for _, name in SCRIPT_RANGES})
SCRIPT_OF = [SCRIPT_NAMES.index(name) for _, name in SCRIPT_RANGES]
SCRIPTS = len(SCRIPT_NAMES)


@cache
def letters() -> np.ndarray:
    """Whether a code point is a letter: its general category is one of L."""
    return np.fromiter((category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


class Block:
    """Texts as word numbers, and what their distinct words are made of."""

    def __init__(self, texts: list[str]):
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        codes = [list(map(index.__getitem__, shared.words_of(t))) for t in texts]
        self.lengths = np.array([len(c) for c in codes], np.int64)
        self.codes = np.fromiter((c for doc in codes for c in doc), np.int32, int(self.lengths.sum()))
        # letters of each word, lower case, with a line feed on either side
        text = "\n" + b"\n".join(index).decode("utf-8", "replace").lower() + "\n" * bool(index)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        points = points[letters()[points] | (points == 10)]
        ends = np.flatnonzero(points == 10)
        self.words = len(index)
        self.letters = np.diff(ends) - 1 if self.words else np.zeros(0, np.int64)
        word_of = np.cumsum(points == 10) - 1
        # trigrams centred on each letter, with the borders as a sign
        at = np.flatnonzero(points != 10)
        a, b, c = points[at - 1], points[at], points[at + 1]
        mixed = ((a * 0x9E3779B1 + b) * 0x85EBCA77 + c) * 0xC2B2AE3D
        self.gram = ((mixed ^ (mixed >> 29)) & ((1 << GRAM_BITS) - 1)).astype(np.int32)
        self.gram_word = word_of[at]
        # the script of most of a word's letters
        script = np.array(SCRIPT_OF)[np.searchsorted(SCRIPT_STARTS, b, side="right") - 1]
        self.script = np.bincount(self.gram_word * SCRIPTS + script, minlength=self.words * SCRIPTS).reshape(-1, SCRIPTS).argmax(axis=1)
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Rows (id, mark, text) of a partition in groups of about BLOCK tokens, judged by their characters."""
    ids, marks, texts, size = [], [], [], 0
    for batch in batches:
        for i, mark, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            ids.append(i)
            marks.append(mark)
            texts.append(text)
            size += len(text)
            if size >= 5 * BLOCK:
                yield ids, marks, texts
                ids, marks, texts, size = [], [], [], 0
    if ids:
        yield ids, marks, texts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, key): trigram counters first, then scripts."""
    keys = (1 << GRAM_BITS) + SCRIPTS
    total: dict[str, np.ndarray] = {}
    for _, langs, texts in _grouped(batches):
        block = Block(texts)
        names, which = np.unique(np.array(langs, object), return_inverse=True)
        for k, name in enumerate(names):
            times = np.bincount(block.codes[which[block.doc] == k], minlength=block.words)
            counts = total.setdefault(name, np.zeros(keys, np.int64))
            counts[: 1 << GRAM_BITS] += np.bincount(block.gram, weights=times[block.gram_word], minlength=1 << GRAM_BITS).astype(np.int64)
            counts[1 << GRAM_BITS :] += np.bincount(block.script, weights=times * (block.letters > 0), minlength=SCRIPTS).astype(np.int64)
    for name, counts in total.items():
        key = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(key), pa.string()), pa.array(key, pa.int32()), pa.array(counts[key])], ["lang", "key", "n"])


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log trigram shares (counter by language) and candidates (script by language), from all rows where learn holds.

    The driver gets a row for each language and counter, whatever the number of documents.
    """
    rows = docs.filter(learn & F.col(lang_col).isNotNull()).select(F.lit(0), F.col(lang_col).cast("string"), shared.text_of(text_col))
    counts = shared.map_arrow(rows, _count, "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique()) if len(counts) else []
    table = np.zeros(((1 << GRAM_BITS) + SCRIPTS, len(langs)))
    if langs:
        table[counts["key"], pd.Categorical(counts["lang"], langs).codes] = counts["n"]
    grams, scripts = table[: 1 << GRAM_BITS] + PRIOR, table[1 << GRAM_BITS :]
    candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    candidate &= scripts > 0
    candidate |= ~candidate.any(axis=1, keepdims=True)  # a script never seen excludes nobody
    return langs, np.log(grams / grams.sum(axis=0)), candidate


def word_scores(block: Block, shares: np.ndarray, candidate: np.ndarray) -> np.ndarray:
    """Score of each distinct word for each language; 0 for all where a word has no letters."""
    n = np.maximum(block.letters, 1)
    sums = np.stack([np.bincount(block.gram_word, weights=shares[block.gram, k], minlength=block.words) for k in range(shares.shape[1])], axis=1)
    scores = WEIGHT * sums / n[:, None]
    scores[~candidate[block.script] & (block.letters > 0)[:, None]] -= 50.0
    return scores


def viterbi(scores: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best language of each token; texts lie one behind the other in codes. A change costs SWITCH; ties go to the earlier language."""
    label = np.zeros(len(codes), np.int16)
    order = np.argsort(-lengths, kind="stable")
    n = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    active = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")
    best_of, changed = np.zeros(len(codes), np.int16), np.zeros((len(codes), scores.shape[1]), bool)
    now = np.zeros((len(n), scores.shape[1]))
    last = np.zeros(len(n), np.int64)
    for t, k in enumerate(active):
        at = starts[:k] + t
        v = now[:k]
        if t:
            best = v.argmax(axis=1)
            top = v[np.arange(k), best] - SWITCH
            changed[at], best_of[at] = v < top[:, None], best
            v = np.maximum(v, top[:, None])
        now[:k] = v + scores[codes[at]]
    if len(n):
        last = now.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        label[at] = last[:k]
        last[:k] = np.where(changed[at, last[:k]], best_of[at], last[:k])
    return label


def label_texts(texts: list[str], model: tuple[list[str], np.ndarray, np.ndarray]) -> tuple[list[str], np.ndarray, pa.ListArray, pa.ListArray]:
    """Language, score, and starts and languages of the spans of each text."""
    langs, shares, candidate = model
    block = Block(texts)
    n, k = len(texts), max(1, len(langs))
    if langs:
        label = viterbi(word_scores(block, shares, candidate), block.codes, block.lengths)
    else:
        label = np.zeros(len(block.codes), np.int16)
    votes = np.bincount(block.doc * k + label, weights=block.letters[block.codes], minlength=n * k).reshape(n, k)
    total = votes.sum(axis=1)
    known = (total > 0) & bool(langs)
    pred = [langs[b] if ok else "und" for b, ok in zip(votes.argmax(axis=1), known, strict=True)]
    score = np.where(known, votes.max(axis=1) / np.maximum(total, 1), 0.0)
    first = np.cumsum(block.lengths) - block.lengths
    new = np.ones(len(label), bool)
    new[1:] = (label[1:] != label[:-1]) | (block.doc[1:] != block.doc[:-1])
    new &= known[block.doc]
    at = np.flatnonzero(new)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(block.doc[at], minlength=n))]).astype(np.int32)
    where = pa.ListArray.from_arrays(pa.array(offsets), pa.array((at - first[block.doc[at]]).astype(np.int32)))
    span = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.array(langs or ["und"], object)[label[at]], pa.string()))
    return pred, score, where, span


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose text has a language with at least the given share of its letters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def decided(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pred, score, _, _ = label_texts([t or "" for b in batches for t in b.column(at).to_pylist()], sent.value)
        keep = pa.array([p != "und" and s >= least for p, s in zip(pred, score, strict=True)], pa.bool_())
        done = 0
        for b in batches:
            yield b.filter(keep.slice(done, b.num_rows))
            done += b.num_rows

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.column(at).nbytes
            # about as much text as a block has elsewhere
            if size >= 5 * BLOCK:
                yield from decided(waiting)
                waiting, size = [], 0
        if waiting:
            yield from decided(waiting)

    return shared.map_arrow(docs, kept, docs.schema)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, span_starts array<int>, span_langs array<string>"


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], held: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score, span_starts, span_langs.

    lang_pred is a learned language, or ``und`` where the text is null or has no letter (score 0, no spans). score is
    the share of the text's letters under that language's label; ties go to the language first in order of name.
    Spans are maximal runs of words with one label: number of the first word, and language. Only the text decides.
    Repeated rows and null identifiers are kept; an empty table gives an empty result; without a learned language
    every row is ``und``; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.string(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.string())]

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held_out, texts in _grouped(batches):
            pred, score, where, span = label_texts(texts, sent.value)
            yield pa.RecordBatch.from_arrays([*(pa.array(v, t) for v, t in zip((ids, held_out, pred, score), kinds, strict=False)), where, span], names)

    rows = docs.select(F.col(id_col).cast("long"), F.lit(False) if held is None else F.coalesce(held, F.lit(False)), shared.text_of(text_col))
    return shared.map_arrow(rows, labelled, SCHEMA)


def op8_language_id(spark, sf_dir):
    docs = shared.table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return identify(docs, train(docs, ~held), held)

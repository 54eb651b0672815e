"""A hidden Markov language model over words.

Latent states emit symbols: every frequent word is one of its own, the end of a text is one, and rarer words share
CLASSES symbols by a hash. A rare word's probability inside its class follows from its corpus count by the add-one
rule, with one place for words never seen, so every word of the corpus is counted and has a probability of its own.
Frequent is what makes up at least 1 / FREQUENT of all tokens; by arithmetic those are no more than FREQUENT words,
so the states' tables have a largest size, whatever the corpus.

1. Texts become blocks of bounded size: words numbered inside the block, their training counts beside them.
2. Counts are summed by word. Blocks get the counts of their rare words back by a join; those of frequent words,
   which would be hot keys of it, come with the model.
3. Baum-Welch: every partition returns its expected counts over whole texts, which are summed by symbol.
4. The scaled forward recursion gives the exact likelihood of each whole text.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Latent states, classes of rare words (symbol CLASSES is the end of a text), rounds of Baum-Welch.
STATES, CLASSES, ROUNDS = 8, 4096, 4
#: A word is frequent from one in so many tokens.
FREQUENT = 1 << 15
#: Tokens after which a block is full; a longer text is a block of its own. Tokens whose recursions run together.
BLOCK, TOGETHER = 3_000_000, 500_000
#: Expected counts are made in single precision and summed in double; scoring is in double throughout.
#: Added to each expected emission and transition count.
PRIOR = 0.1

BLOCK_SCHEMA = (
    "block long, ids array<long>, held array<boolean>, lengths array<int>, codes binary, words array<binary>, train array<long>"
)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the (id, held, text as bytes) rows of a partition."""
    block = TaskContext.get().partitionId() << 33
    names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]

    def new():
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        return index, [], [], [], 0

    def row() -> pa.RecordBatch:
        codes = np.concatenate(docs) if docs else np.zeros(0, np.int32)
        used = np.repeat(~np.array(held, bool), [len(x) for x in docs])
        train = np.bincount(codes[used], minlength=len(index))
        packed = zstandard.compress(codes.tobytes(), 1)
        values = (block, ids, held, [len(x) for x in docs], packed, list(index), train)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    index, ids, held, docs, size = new()
    for batch in batches:
        for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            words = text.as_py().lower().split()
            docs.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
            ids.append(doc)
            held.append(out)
            size += len(words) + 1
            if size >= BLOCK:
                yield row()
                block += 1
                index, ids, held, docs, size = new()
    if ids:
        yield row()


def text_blocks(docs: DataFrame, held, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(held, F.lit(False)), shared.text_of(text_col).cast("binary"))
    return shared.written(shared.map_arrow(rows, _blocks, BLOCK_SCHEMA), "lm-blocks")


class Vocabulary(NamedTuple):
    """What the corpus says of words: all that the driver gets of it, no larger than FREQUENT words and CLASSES classes."""

    #: Number and training count of each frequent word, by the word.
    frequent: dict[bytes, tuple[int, int]]
    #: Training tokens of each symbol; of each class also its distinct words.
    tokens: np.ndarray
    words: np.ndarray
    #: All training tokens, distinct ones, and ends of texts among them.
    total: int
    distinct: int
    ends: int

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each word, and the training count of those that are frequent (0 of the others)."""
        found = [self.frequent.get(w) for w in words]
        symbol = np.fromiter((CLASSES + 1 + f[0] if f else zlib.crc32(w) % CLASSES for f, w in zip(found, words, strict=True)), np.int32, len(words))
        return symbol, np.fromiter((f[1] if f else 0 for f in found), np.int64, len(words))


def corpus_counts(blocks: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and rows (block, pos, count): training counts over all blocks of the rare words of each block."""
    words = blocks.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("pos", "w")).select("block", "pos", F.col("w.words").alias("word"), "w.train")
    totals = shared.written(words.groupBy("word").agg(F.sum("train").alias("count")).filter("count > 0"), "lm-words")
    sums = totals.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    ends = blocks.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    total = sums[0] + ends
    often = F.col("count") * FREQUENT >= total
    frequent = sorted(totals.filter(often).collect())
    by_class = totals.filter(~often).groupBy(F.pmod(F.crc32("word"), F.lit(CLASSES)).cast("int").alias("class")).agg(F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("words")).toPandas()
    tokens, distinct = np.zeros(CLASSES + 1 + len(frequent)), np.zeros(CLASSES)
    tokens[by_class["class"]], distinct[by_class["class"]] = by_class["tokens"], by_class["words"]
    tokens[CLASSES] = ends
    tokens[CLASSES + 1 :] = [r["count"] for r in frequent]
    known = {bytes(r["word"]): (k, r["count"]) for k, r in enumerate(frequent)}
    # frequent words leave before the shuffle by word; they are FREQUENT at most
    rare = words.select("block", "pos", "word").join(F.broadcast(totals.filter(often).select("word")), "word", "left_anti")
    counts = rare.join(totals.filter(~often), "word").select("block", "pos", "count")
    return Vocabulary(known, tokens, distinct, total, sums[1] + (ends > 0), ends), counts


def _sequences(codes: bytes, symbol: np.ndarray, end: int, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes, symbol of each token with an end behind each text, and where texts start among those."""
    words = np.frombuffer(zstandard.decompress(codes), np.int32)
    n = lengths.astype(np.int64) + 1
    starts = np.concatenate([[0], np.cumsum(n)])[:-1]
    seq = np.full(int(n.sum()), end, np.int32)
    body = np.ones(len(seq), bool)
    body[starts + n - 1] = False
    seq[body] = symbol[words]
    return words, seq, starts


def together(n: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of sequences of similar length, the longest first, about TOGETHER tokens at a time; a longer one alone."""
    order = np.argsort(-n, kind="stable")
    group = (np.cumsum(n[order]) - 1) // TOGETHER
    yield from np.split(order, np.flatnonzero(np.diff(group)) + 1)


def by_time(starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that puts the first tokens of all sequences before the second ones, and so on.

    starts and n belong to sequences sorted by falling length, so those still running are always the first ones.
    Returns the tokens' places, their sequences, and how many sequences run at each step.
    """
    active = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")
    which = np.arange(int(n.sum())) - np.repeat(np.cumsum(active) - active, active)
    return starts[which] + np.repeat(np.arange(len(active)), active), which, active


def forward(seq: np.ndarray, active: np.ndarray, model: tuple, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Scaled forward recursion over tokens in order of time: the scale of each token, and the scaled values if they are to be kept.

    The sum of a sequence's log scales is its log-likelihood. Arrays have a row for each state, so that every
    operation runs along the sequences.
    """
    first, step, emit = model
    scale = np.empty(len(seq), emit.dtype)
    alpha = np.empty((len(first), len(seq)), emit.dtype) if keep else None
    move, now, at = np.ascontiguousarray(step.T), None, 0
    for k in active:
        here = emit.take(seq[at : at + k], axis=1)
        here *= first[:, None] if now is None else move @ now[:, :k]
        s = here.sum(axis=0)
        here /= s
        scale[at : at + k] = s
        if keep:
            alpha[:, at : at + k] = here
        now, at = here, at + k
    return scale, alpha


def expected_counts(seq: np.ndarray, active: np.ndarray, model: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions (state by class) of sequences whose tokens are in order of time."""
    first, step, emit = model
    scale, alpha = forward(seq, active, model, keep=True)
    states, moves = len(first), np.zeros((len(first), len(first)))
    ends = np.cumsum(active)
    beta = np.ones((states, active[-1] if len(active) else 0), emit.dtype)
    for t in range(len(active) - 1, -1, -1):
        lo, hi = ends[t] - active[t], ends[t]
        now = alpha[:, lo:hi]
        if t:
            # what the step before needs of this one
            ahead = emit.take(seq[lo:hi], axis=1)
            ahead *= beta
            ahead /= scale[lo:hi]
            k = active[t - 1]
            before = alpha[:, lo - k : lo]
            moves += before[:, : hi - lo] @ ahead.T
            now *= beta  # alpha holds gamma from here on
            beta = np.ones((states, k), emit.dtype)
            beta[:, : hi - lo] = step @ ahead
        else:
            now *= beta
    emissions = np.stack([np.bincount(seq, weights=alpha[s], minlength=emit.shape[1]) for s in range(states)])
    starts = alpha[:, : active[0]].sum(axis=1) if len(active) else np.zeros(states)
    return starts, moves * step, emissions


def start_model(symbol_tokens: np.ndarray) -> tuple:
    """States that differ by a fixed random tilt of the corpus's symbol shares and like to stay as they are."""
    rng = np.random.default_rng(7)
    share = (symbol_tokens + 1) / (symbol_tokens + 1).sum()
    emit = share * rng.gamma(4.0, 0.25, (STATES, len(share)))
    step = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
    np.fill_diagonal(step, 0.9)
    return np.full(STATES, 1 / STATES), step, emit / emit.sum(axis=1, keepdims=True)


def baum_welch(blocks: DataFrame, vocabulary, model: tuple, rounds: int = ROUNDS) -> tuple:
    """The model after the given rounds over all training texts, each as a whole.

    ``vocabulary`` is a broadcast Vocabulary. What reaches the driver is states by symbols, whatever the input.
    """
    spark = blocks.sparkSession
    body = blocks.select("held", "lengths", "codes", "words")
    symbols = model[2].shape[1]
    names = [f"s{k}" for k in range(STATES)]
    for _ in range(rounds):
        current = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            total, fast = None, tuple(x.astype(np.float32) for x in current.value)
            for batch in batches:
                for k in range(batch.num_rows):
                    lengths = batch.column(1)[k].values.to_numpy()
                    symbol, _ = vocabulary.value.symbols(batch.column(3)[k].as_py())
                    _, seq, starts = _sequences(batch.column(2)[k].as_py(), symbol, CLASSES, lengths)
                    used = np.flatnonzero(~np.array(batch.column(0)[k].as_py(), bool))
                    n = lengths[used].astype(np.int64) + 1
                    for part in together(n) if len(n) else ():
                        place, _, active = by_time(starts[used[part]], n[part])
                        got = expected_counts(seq[place], active, fast)
                        total = got if total is None else tuple(a + b for a, b in zip(total, got, strict=True))
            if total is not None:
                first, moves, emissions = total
                table = np.concatenate([emissions.T, moves, first[None]])  # a row for each symbol, then state, then the start
                key = np.flatnonzero(table.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), *(pa.array(table[key, k]) for k in range(STATES))], ["key", *names])

        sums = shared.map_arrow(body, expect, "key int, " + ", ".join(f"{x} double" for x in names)).groupBy("key").agg(*(F.sum(x).alias(x) for x in names)).toPandas()
        if len(sums):
            table = np.zeros((symbols + STATES + 1, STATES))
            table[sums["key"]] = sums[names]
            emit, moves, first = table[:symbols] + PRIOR, table[symbols:-1] + PRIOR, table[-1] + PRIOR
            model = first / first.sum(), moves / moves.sum(axis=1, keepdims=True), np.ascontiguousarray((emit / emit.sum(axis=0)).T)
        current.unpersist()
    return model


def word_emissions(model: tuple, vocabulary: Vocabulary, symbol: np.ndarray, count: np.ndarray) -> np.ndarray:
    """P(word | state), a row for each state, of words with the given symbols and training counts; the end of a text in the last column."""
    emit = model[2].take(np.append(symbol, CLASSES), axis=1)
    rare = np.flatnonzero(symbol < CLASSES)
    inside = vocabulary.tokens[:CLASSES] + vocabulary.words + 1
    emit[:, rare] *= (count[rare] + 1) / inside[symbol[rare]]
    return emit


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fit(docs: DataFrame, held, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, Vocabulary, tuple]:
    """Blocks of all texts, counts of their rare words, vocabulary and model, learned where ``held`` is false or null."""
    blocks = text_blocks(docs, held, id_col, text_col)
    vocabulary, counts = corpus_counts(blocks)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return blocks, counts, vocabulary, baum_welch(blocks, sent, start_model(vocabulary.tokens), rounds)


def score_texts(docs: DataFrame, held, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts where the condition ``held`` is true are not learned from (a null condition is false). A null text counts
    as empty; each text ends with one end token. base_score is the add-one unigram score, score the HMM's, both
    log10 of the probability of the whole text. Repeated rows count as often as they occur; other columns are
    ignored; an empty table gives an empty result, and with nothing to learn from, words cost nothing and classes
    are equally likely up to the model's fixed start.
    """
    blocks, counts, vocabulary, model = fit(docs, held, id_col, text_col, rounds)
    learned = docs.sparkSession.sparkContext.broadcast((model, vocabulary))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary = learned.value
        names = [x.split()[0] for x in SCORE_SCHEMA.split(", ")]
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
                lengths = row["lengths"].values.to_numpy()
                symbol, count = vocabulary.symbols(row["words"].as_py())
                if row["pos"].is_valid:
                    count[row["pos"].values.to_numpy()] = row["counts"].values.to_numpy()
                codes, seq, starts = _sequences(row["codes"].as_py(), np.arange(len(symbol)), len(symbol), lengths)
                n = lengths.astype(np.int64) + 1
                gain = np.log10(count + 1)
                doc = np.repeat(np.arange(len(n)), lengths)
                known = np.bincount(doc, weights=count[codes] > 0, minlength=len(n)) + (vocabulary.ends > 0)
                base = np.bincount(doc, weights=gain[codes], minlength=len(n)) + np.log10(vocabulary.ends + 1) - n * np.log10(vocabulary.total + vocabulary.distinct + 1)
                emit = word_emissions(model, vocabulary, symbol, count)
                likelihood = np.empty(len(n))
                for part in together(n):
                    place, which, active = by_time(starts[part], n[part])
                    scale, _ = forward(seq[place], active, (*model[:2], emit))
                    likelihood[part] = np.bincount(which, weights=np.log10(scale), minlength=len(part))
                columns = [row["ids"].values, row["held"].values, n, known.astype(np.int64), np.full(len(n), vocabulary.total), base, likelihood]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    listed = counts.groupBy("block").agg(F.collect_list(F.struct("pos", "count")).alias("c")).select("block", F.col("c.pos").alias("pos"), F.col("c.count").alias("counts"))
    body = blocks.select("block", "ids", "held", "lengths", "codes", "words").join(listed, "block", "left")
    return shared.map_arrow(body.drop("block"), scored, SCORE_SCHEMA)


def op2_hmm_scoring(spark, sf_dir):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score_texts(shared.table(spark, sf_dir, "documents"), held)

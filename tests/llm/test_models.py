from __future__ import annotations

import itertools
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallow.llm import hmm_scoring, language_id, shared
from tallow.llm.registry import QUERIES
from tests.conftest import SF
from tests.llm.common import ROWS, docs


def test_counts_match_the_textbook_recursions():
    rng = np.random.default_rng(1)
    states, classes = 3, 20
    n = np.sort(rng.integers(1, 40, 30))[::-1].copy()
    starts = np.cumsum(n) - n
    seq = rng.integers(0, classes, n.sum())
    model = rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states)
    place, which, active = hmm_scoring.by_time(starts, n)
    scale, _ = hmm_scoring.forward(seq[place], active, model)
    first, step, emit = model
    likelihood, begin, moves, emitted = [], np.zeros(states), np.zeros((states, states)), np.zeros((states, classes))
    for at, size in zip(starts, n, strict=True):
        o = seq[at : at + size]
        alpha, beta = np.zeros((size, states)), np.ones((size, states))
        alpha[0] = first * emit[:, o[0]]
        for t in range(1, size):
            alpha[t] = (alpha[t - 1] @ step) * emit[:, o[t]]
        for t in range(size - 2, -1, -1):
            beta[t] = step @ (emit[:, o[t + 1]] * beta[t + 1])
        p = alpha[-1].sum()
        likelihood.append(math.log(p))
        gamma = alpha * beta / p
        begin += gamma[0]
        for t in range(size):
            emitted[:, o[t]] += gamma[t]
        for t in range(size - 1):
            moves += np.outer(alpha[t], emit[:, o[t + 1]] * beta[t + 1]) * step / p
    assert np.allclose(np.bincount(which, weights=np.log(scale)), likelihood)
    for got, expected in zip(hmm_scoring.expected_counts(seq[place], active, model), (begin, moves, emitted), strict=True):
        assert np.allclose(got, expected)


def base_scores(rows, held):
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    count = {}
    for i, w in words.items():
        if not held(i):
            for x in [*w, None]:
                count[x] = count.get(x, 0) + 1
    total, distinct = sum(count.values()), len(count)
    score = {i: sum(math.log10((count.get(x, 0) + 1) / (total + distinct + 1)) for x in [*w, None]) for i, w in words.items()}
    known = {i: sum(x in count for x in [*w, None]) for i, w in words.items()}
    return score, known, total


def test_scores(spark, monkeypatch):
    rows = [(i, t) for i, t in dict(ROWS).items() if i is not None]
    for block in (1_000_000, 40):
        monkeypatch.setattr(hmm_scoring, "BLOCK", block)
        got = hmm_scoring.score_texts(docs(spark, rows), F.col("doc_id") % 4 == 2, rounds=2).collect()
        score, known, total = base_scores(rows, lambda i: i % 4 == 2)
        assert len(got) == len(rows)
        for r in got:
            assert r.held_out == (r.doc_id % 4 == 2) and r.train_tokens == total and r.n_known == known[r.doc_id]
            assert math.isclose(r.base_score, score[r.doc_id], rel_tol=1e-9) and r.score < 0
    assert hmm_scoring.score_texts(docs(spark, []), F.lit(False), rounds=1).count() == 0
    nothing = hmm_scoring.score_texts(docs(spark, rows[:3]), F.lit(True), rounds=1).collect()
    assert all(r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in nothing)


def test_probabilities_of_one_step_sum_to_one():
    """Class shares of the next token, over all states and classes, whatever came before."""
    first, step, emit = hmm_scoring.start_model(np.arange(hmm_scoring.CLASSES + 1))
    assert math.isclose(first.sum(), 1) and np.allclose(step.sum(axis=1), 1) and np.allclose(emit.sum(axis=1), 1)


def plain_forward(words, emission, model):
    """log10 of a text's probability by the recursion alone, in logarithms."""
    first, step, _ = model
    now = None
    for w in [*words, None]:
        before = np.log(first) if now is None else np.logaddexp.reduce(now[:, None] + np.log(step), axis=0)
        now = before + np.log(emission(w))
    return np.logaddexp.reduce(now) / math.log(10)


def test_score_is_the_plain_recursion(spark, monkeypatch):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in d.collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in texts.items() if not held(i) for w in t)
    for frequent, block in ((hmm_scoring.FREQUENT, hmm_scoring.BLOCK), (300, 5000)):
        monkeypatch.setattr(hmm_scoring, "FREQUENT", frequent)
        monkeypatch.setattr(hmm_scoring, "BLOCK", block)
        monkeypatch.setattr(hmm_scoring, "TOGETHER", 5 * block // 6)
        condition = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
        _, _, vocabulary, model = hmm_scoring.fit(d, condition, rounds=2)
        total = sum(count.values()) + sum(not held(i) for i in texts)
        assert vocabulary.total == total and {w for w, c in count.items() if c * frequent >= total} == set(vocabulary.frequent)

        def emission(word, vocabulary=vocabulary, model=model):
            if word is None:
                return model[2][:, hmm_scoring.CLASSES]
            if word in vocabulary.frequent:
                return model[2][:, hmm_scoring.CLASSES + 1 + vocabulary.frequent[word][0]]
            k = zlib.crc32(word) % hmm_scoring.CLASSES
            return model[2][:, k] * (count.get(word, 0) + 1) / (vocabulary.tokens[k] + vocabulary.words[k] + 1)

        # all words and, for each class, one that was never seen
        rare = [w for w in count if w not in vocabulary.frequent]
        unseen = (model[2][:, : hmm_scoring.CLASSES] / (vocabulary.tokens[: hmm_scoring.CLASSES] + vocabulary.words + 1)).sum(axis=1)
        assert np.allclose(sum(emission(w) for w in [None, *vocabulary.frequent, *rare]) + unseen, 1)
        got = hmm_scoring.score_texts(d, condition, rounds=2).collect()
        for r in sorted(got, key=lambda r: r.n_tokens)[:60]:
            assert math.isclose(r.score, plain_forward(texts[r.doc_id], emission, model), rel_tol=1e-6)


def test_no_text_is_cut_in_training(spark):
    d = docs(spark)
    blocks = hmm_scoring.text_blocks(d, F.lit(False), "doc_id", "text")
    vocabulary, _ = hmm_scoring.corpus_counts(blocks)
    sent = spark.sparkContext.broadcast(vocabulary)
    first, step, emit = hmm_scoring.baum_welch(blocks, sent, hmm_scoring.start_model(vocabulary.tokens), 1)
    whole = np.zeros(vocabulary.tokens.shape)
    starts = np.zeros(hmm_scoring.STATES)
    moves = np.zeros((hmm_scoring.STATES, hmm_scoring.STATES))
    start = hmm_scoring.start_model(vocabulary.tokens)
    emitted = np.zeros((hmm_scoring.STATES, len(vocabulary.tokens)))
    for _, t in ROWS:
        words = (t or "").encode().lower().split()
        seq = np.append(vocabulary.symbols(words)[0], hmm_scoring.CLASSES)
        a, m, e = hmm_scoring.expected_counts(seq, np.ones(len(seq), int), start)
        starts, moves, emitted = starts + a, moves + m, emitted + e
        whole += np.bincount(seq, minlength=len(whole))
    assert np.allclose(emitted.sum(axis=0), whole) and math.isclose(starts.sum(), len(ROWS))
    share = lambda x, axis: (x + hmm_scoring.PRIOR) / (x + hmm_scoring.PRIOR).sum(axis=axis, keepdims=True)
    for got, wanted in ((first, share(starts, 0)), (step, share(moves, 1)), (emit, share(emitted, 1))):
        assert np.allclose(got, wanted, rtol=1e-3)


def test_better_than_base_on_held_out_texts(spark):

    total = QUERIES["op2_hmm_scoring"](spark, SF).filter("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert total.score > total.base


def test_language_accuracy(spark):

    got = QUERIES["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return language_id.train(d, F.lit(True))


def test_language_edges(spark, model):
    got = language_id.identify(docs(spark), model).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (3, 4, 5, 8):
            assert r.lang_pred == "und" and r.score == 0 and r.span_starts == []
        else:
            assert r.lang_pred in model[0] and r.span_starts[0] == 0
    assert language_id.identify(docs(spark, []), model).count() == 0
    langs, _, _ = nothing = language_id.train(docs(spark, []), F.lit(True))
    assert langs == [] and all(r.lang_pred == "und" for r in language_id.identify(docs(spark), nothing).collect())
    kept = language_id.keep_identified(docs(spark), model)
    assert kept.columns == docs(spark).columns and {3, 4, 5, 8}.isdisjoint(r.doc_id for r in kept.collect())


def test_spans_of_mixed_text(spark, model):
    d = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars BETWEEN 400 AND 900").collect()}
    a, b = d["en"].split()[:40], d["de"].split()[:30]
    pred, _, starts, langs = language_id.label_texts([" ".join(a + b)], model)
    assert pred == ["en"] and langs.to_pylist()[0][0] == "en" and langs.to_pylist()[0][-1] == "de"
    assert any(abs(s - 40) <= 4 for s in starts.to_pylist()[0])


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(3)
    scores = rng.normal(0, 4, (12, 3))
    lengths = np.array([5, 0, 7, 1])
    codes = rng.integers(0, 12, lengths.sum())
    label = language_id.viterbi(scores, codes, lengths)
    worth = lambda path, c: sum(scores[w, k] for w, k in zip(c, path, strict=True)) - language_id.SWITCH * sum(x != y for x, y in itertools.pairwise(path))
    for at, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        c = codes[at : at + n]
        best = max((worth(p, c) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert math.isclose(worth(label[at : at + n], c), best, abs_tol=1e-9)


def test_letters_are_those_of_category_l(spark, model):
    texts = ["½", "²", "Ⅷ", "①", "12 ½ !!", "_", "\u0301", "a½", "ª", "漢", "नमस्ते"]
    pred, score, _, _ = language_id.label_texts(texts, model)
    assert [p == "und" for p in pred] == [True] * 7 + [False] * 4
    assert (score[:7] == 0).all() and (score[7:] > 0).all()


def test_spans_in_the_query(spark):
    got = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert len(r.span_starts) == len(r.span_langs) and (r.span_starts[0] == 0 if r.lang_pred != "und" else not r.span_starts)
        assert all(a != b for a, b in itertools.pairwise(r.span_langs))


class PlainLanguages:
    """Counts, scores and labels by plain loops over letters, words and languages; of the module only its stated constants."""

    def __init__(self, rows):
        self.known = {}
        grams, scripts = defaultdict(Counter), defaultdict(Counter)
        for text, lang in rows:
            for word, times in Counter(self.words(text)).items():
                letters, counters, script = self.parts(word)
                for g in counters:
                    grams[lang][g] += times
                if letters:
                    scripts[lang][script] += times
        self.langs = sorted({lang for _, lang in rows})
        self.grams, self.totals = grams, {x: sum(grams[x].values()) + language_id.PRIOR * 2**language_id.GRAM_BITS for x in self.langs}
        self.allowed = {}
        for name in language_id.SCRIPT_NAMES:
            fits = [x for x in self.langs if scripts[x][name] > 0 and scripts[x][name] >= language_id.SCRIPT_SHARE * sum(scripts[x].values())]
            self.allowed[name] = fits or self.langs

    @staticmethod
    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text or "")

    def parts(self, word):
        """How many letters a word has, the counters of its trigrams, and the script of most letters (the first by name of several)."""
        if word not in self.known:
            letters = [ord(c) for c in word.lower() if unicodedata.category(c)[0] == "L"]
            counters = []
            for a, b, c in zip([10, *letters], letters, [*letters[1:], 10], strict=False):
                mixed = ((a * 0x9E3779B1 + b) * 0x85EBCA77 + c) * 0xC2B2AE3D % 2**64
                counters.append((mixed ^ mixed >> 29) % 2**language_id.GRAM_BITS)
            names = Counter(next(name for first, name in reversed(language_id.SCRIPT_RANGES) if first <= b) for b in letters)
            self.known[word] = len(letters), counters, min(names, key=lambda n: (-names[n], n), default="")
        return self.known[word]

    def score(self, word, lang):
        letters, counters, script = self.parts(word)
        if not letters:
            return 0.0
        mean = sum(math.log((self.grams[lang][g] + language_id.PRIOR) / self.totals[lang]) for g in counters) / letters
        return language_id.WEIGHT * mean - 50.0 * (lang not in self.allowed[script])

    def label(self, text):
        """The text's language, that language's share of its letters, and the worth of the best labelling with its labels."""
        words = self.words(text)
        best = dict.fromkeys(self.langs, 0.0)
        steps = []
        for w in words:
            came = {x: max(self.langs, key=lambda y: best[y] - language_id.SWITCH * (x != y)) for x in self.langs}  # noqa: B023
            best = {x: best[came[x]] - language_id.SWITCH * (x != came[x]) + self.score(w, x) for x in self.langs}
            steps.append(came)
        path = [max(self.langs, key=best.get)] if words else []
        for came in reversed(steps[1:]):
            path.append(came[path[-1]])
        path.reverse()
        votes = Counter()
        for w, x in zip(words, path, strict=True):
            votes[x] += self.parts(w)[0]
        total = votes.total()
        if not total:
            return "und", 0.0, path
        lang = min(votes, key=lambda x: (-votes[x], x))
        return lang, votes[lang] / total, path


def test_language_query_against_brute_force(spark):
    """Training, scores, scripts and labels of the whole query are computed again from the texts alone."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    plain = PlainLanguages([(r.text, r.lang) for r in rows if r.lang is not None and not held(r.doc_id)])
    got = {r.doc_id: r for r in QUERIES["op8_language_id"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        lang, share, path = plain.label(r.text)
        g = got[r.doc_id]
        assert (g.held_out, g.lang_pred) == (held(r.doc_id), lang) and abs(g.score - share) < 1e-9
        starts = [k for k, x in enumerate(path) if lang != "und" and (k == 0 or x != path[k - 1])]
        assert (g.span_starts, g.span_langs) == (starts, [path[k] for k in starts])


def test_mixed_texts_against_brute_force(spark, model):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").collect()
    plain = PlainLanguages([(r.text, r.lang) for r in rows if r.lang is not None])
    texts = [r.text for r in rows if r.text and 20 <= len(r.text) <= 900][:30]
    texts = [a[:150] + " " + b[-150:] for a, b in itertools.pairwise(texts)] + ["漢字 and русский text", "Ⅷ ½ a", "ΟΔΟΣ street"]
    pred, score, _, _ = language_id.label_texts(texts, model)
    for text, p, s in zip(texts, pred, score, strict=True):
        lang, share, _ = plain.label(text)
        assert p == lang and abs(s - share) < 1e-9


def test_frequent_words_leave_before_the_shuffle(spark):
    """The rows that are dealt out by word are those of rare words alone."""
    blocks = hmm_scoring.text_blocks(docs(spark), F.lit(False), "doc_id", "text")
    vocabulary, counts = hmm_scoring.corpus_counts(blocks)
    assert vocabulary.frequent
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    anti = plan.index("LeftAnti")
    assert plan.index("Inner") < anti and "broadcast" in plan[anti:]
    held = {(r.block, r.pos): bytes(r.word) for r in blocks.select("block", F.posexplode("words").alias("pos", "word")).collect()}
    assert all(held[r.block, r.pos] not in vocabulary.frequent for r in counts.collect())

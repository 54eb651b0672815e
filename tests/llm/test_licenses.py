"""License scans against brute force."""

from __future__ import annotations

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallow.llm import license_scan, registry
from tallow.llm.license_templates import BASE, TEMPLATES, Template
from tests.conftest import SF
from tests.llm.common import ROWS, docs

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute_base(text):
    """(label, start) of all places of the contract's phrases."""
    w = tokens(text)
    return sorted((label, i) for label, p in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())


def least_errors(words, template):
    """Fewest edits that make some stretch of words the template: the plain table of edit distances."""
    column = list(range(len(template) + 1))
    best = column[-1]
    for word in words:
        now = [0]
        for k, t in enumerate(template, 1):
            now.append(min(now[k - 1] + 1, column[k] + 1, column[k - 1] + (t != word)))
        column, best = now, min(best, now[-1])
    return best


def brute_labels(text):
    w, out = tokens(text), set()
    for t in TEMPLATES:
        words = tokens(t.text)
        if least_errors(w, words) <= (1 - t.least) * len(words) + 1e-9:
            out.add(t.label)
    return sorted(out)


def edited(rng, text, share):
    """A text with about a share of its words dropped, doubled or replaced."""
    out = []
    for word in text.split():
        kind = rng.random() / share
        out += [] if kind < 1 / 3 else [word, "more"] if kind < 2 / 3 else ["other"] if kind < 1 else [word]
    return " ".join(out)


def cases():
    rng = random.Random(8)
    words = "the of software this is provided and license copy any person in no event use".split()
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    out = [*ROWS, (20, "Released under the MIT License. Not under  THE mit-license!"), (21, "CC BY-NC 4.0, cc by nc; Apache License, Version 2.0"), (22, "under the mit")]
    out += [(23, "GNU General Public License, version 3 " + filler(300) + " gnu general public license version 2"), (24, filler(3000)), (25, "cc by nc " * 2000)]
    for k, t in enumerate(TEMPLATES):
        for j, share in enumerate((0.001, 0.1, 0.18, 0.3)):
            out.append((100 + 10 * k + j, f"{filler(rng.randrange(60))} {edited(rng, t.text, share)} {filler(rng.randrange(60))}"))
    return out


def test_against_brute_force(spark):
    rows = cases()
    got = license_scan.scan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        for r in by_id[i]:
            assert r.n_words == len(tokens(text))
            assert sorted((s.label, s.first_word) for s in r.spans if s.base) == brute_base(text)
            assert sorted({s.label for s in r.spans}) == brute_labels(text)
            for s in r.spans:
                found, words = tokens(text)[s.first_word : s.last_word + 1], tokens(TEMPLATES[s.template].text)
                assert s.errors == least_errors(found, words) and abs(s.score - (1 - s.errors / len(words))) < 1e-12


def test_query(spark):
    got = registry.QUERIES["op12_license_scan"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert any(r.n_base for r in got)
    for r in got:
        places, labels = brute_base(texts[r.doc_id]), brute_labels(texts[r.doc_id])
        starts = [i for _, i in places]
        assert (r.n_words, r.n_base) == (len(tokens(texts[r.doc_id])), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({b for b, _ in places})) and r.labels == ",".join(labels)
        assert (r.score > 0) == bool(labels) and 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*labels, ""}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), min_size=6, max_size=20), st.sampled_from([0.9, 0.85]))
def test_bits_give_the_edit_distance(text, template, least):
    s = license_scan.Sought(0, Template("t", " ".join(template), least)) if len(template) - 2 - 3 * int((1 - least) * len(template) + 1e-9) > 0 else None
    if s is None:
        return
    for end in range(1, len(text) + 1):
        plain = least_errors_ending(text[:end], template)
        assert dict(s.ends(text)).get(end) == (plain if plain <= s.errors else None)
    for first, end, errors in s.places(text):
        assert least_errors(text[first:end], template) <= errors == least_errors_ending(text[:end], template)


def least_errors_ending(words, template):
    column = list(range(len(template) + 1))
    for word in words:
        now = [0]
        for k, t in enumerate(template, 1):
            now.append(min(now[k - 1] + 1, column[k] + 1, column[k - 1] + (t != word)))
        column = now
    return column[-1]


def test_phrases_that_overlap_themselves():
    s = license_scan.Sought(0, Template("t", "la la la", 1.0))
    assert [p[0] for p in s.places(["la"] * 5)] == [0, 1, 2]
    assert [t.label for t in BASE] == list(PHRASES)


def test_votes_come_from_a_join_without_a_shuffle_of_words(spark):
    """Rolling hashes meet the templates where they are; only hits are dealt out."""
    plan = license_scan.bands(docs(spark).select(F.col("doc_id").cast("string").alias("key"), "text"), license_scan.compiled(TEMPLATES))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_empty_table(spark):
    assert license_scan.scan(docs(spark, [])).collect() == []

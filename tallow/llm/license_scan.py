r"""License scans by diagonal voting.

Every document and template is a sequence of words (``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``, A-Z lower-cased), and every run of GRAM
words has a hash. Spark joins all rolling hashes of all documents to the positions of the same hashes in the templates; a hit
votes for its diagonal, the document's position less the template's. Diagonals that lie as near to one another as the template
allows errors are merged, and a merged band with enough votes is a candidate, whose words are compared with the template.

Nothing is lost on the way: of a template of m words with at most e words inserted, deleted or replaced, at least
m - GRAM + 1 - GRAM * e runs stay whole, on diagonals at most e apart. That is the number of votes that a band needs, and e is
(1 - least) * m. Three words are a run because the shortest phrases have three; a template must be long enough to need a vote.

A hit is a row only where a template has the hash, so the exploded hashes of the documents never leave their task while the
templates' positions are few. Of the texts, those with a candidate are fetched for the comparison; a filter of one bit a
key keeps the others out of the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared
from .license_templates import BASE, TEMPLATES, Template

GRAM = 3
#: Positions of templates up to which the join sends them to every executor; beyond it Spark chooses the join by itself.
FEW = 200_000

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWERED = str.maketrans(UPPER, LOWER)
SPAN = "label string, template int, base boolean, first_word long, last_word long, errors int, score double"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWERED))


def words(text: Column) -> Column:
    """The same of a column."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN), lambda w: w != "")


def grams(found: Column) -> Column:
    """Hashes of all runs of GRAM words, in order; none of fewer words."""
    # the words are an element of a list, so that they are computed once and not for every run
    hashes = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (GRAM - 1)), lambda i: F.xxhash64(*(F.element_at(w, i + k) for k in range(GRAM))))
    return F.element_at(F.transform(F.array(found), lambda w: F.when(F.size(w) >= GRAM, hashes(w)).otherwise(F.array().cast("array<bigint>"))), 1)


class Sought:
    """A template's words, the errors that it allows and the votes that a band of its diagonals needs."""

    def __init__(self, number: int, template: Template):
        self.number, self.label, self.words = number, template.label, words_of(template.text)
        self.base = template in BASE
        m = len(self.words)
        self.errors = int((1 - template.least) * m + 1e-9)
        self.votes = m - GRAM + 1 - GRAM * self.errors
        if self.votes < 1:
            raise ValueError(f"the template {template.text[:40]!r} is too short for its share of {template.least}")
        #: For every word, the bits of its positions.
        self.masks: dict[str, int] = {}
        for k, word in enumerate(self.words):
            self.masks[word] = self.masks.get(word, 0) | 1 << k

    def ends(self, text: Sequence[str]) -> Iterator[tuple[int, int]]:
        """(end, errors) of every position of text where a place of the template with few enough errors ends.

        The columns of the table of edit distances are kept as bits of their differences, a column a word.
        """
        m = len(self.words)
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, errors = full, 0, m
        for k, word in enumerate(text):
            eq = self.masks.get(word, 0)
            cross = eq | down
            across = (((eq & up) + up) ^ up) | eq
            plus, minus = down | ~(across | up) & full, up & across
            if plus & top:
                errors += 1
            elif minus & top:
                errors -= 1
            plus, minus = plus << 1 & full, minus << 1 & full
            up, down = minus | ~(cross | plus) & full, plus & cross
            if errors <= self.errors:
                yield k + 1, errors

    def places(self, text: Sequence[str]) -> Iterator[tuple[int, int, int]]:
        """(first, end, errors) of the template's places: every exact one, where errors are allowed the best of each run of ends, the first of several."""
        if not self.errors:
            yield from ((end - len(self.words), end, 0) for end, _ in self.ends(text))
            return
        run: tuple[int, int] | None = None
        last = -2
        for end, errors in [*self.ends(text), (len(text) + 2, -1)]:
            if run is not None and end > last + 1 or errors < 0:
                if run is not None:
                    yield self._first(text, *run), *run
                run = None
            if errors >= 0 and (run is None or errors < run[1]):
                run = (end, errors)
            last = end

    def _first(self, text: Sequence[str], end: int, errors: int) -> int:
        """Where the place that ends there starts: the latest start with as many errors, found from the end backwards."""
        if not errors:
            return end - len(self.words)
        m = len(self.words)
        before = list(range(m + 1))
        for back in range(1, m + errors + 1):
            word = text[end - back] if end >= back else None
            now = [back]
            for k in range(1, m + 1):
                now.append(min(now[k - 1] + 1, before[k] + 1, before[k - 1] + (self.words[m - k] != word)))
            if now[m] <= errors:
                return end - back
            before = now
        return end - m


def compiled(templates: Iterable[Template]) -> list[Sought]:
    return [Sought(k, t) for k, t in enumerate(templates)]


def bands(docs: DataFrame, sought: list[Sought]) -> DataFrame:
    """Candidates: rows (key, template, low, high) of merged diagonals with enough votes. docs has key and text."""
    spark = docs.sparkSession
    templates = spark.createDataFrame([(s.number, s.words, s.errors, s.votes) for s in sought], "template int, words array<string>, errors int, needed int")
    positions = templates.select("template", "errors", "needed", F.posexplode(grams(F.col("words"))).alias("at", "gram"))
    if sum(len(s.words) for s in sought) <= FEW:
        positions = F.broadcast(positions)
    rolling = docs.select("key", F.posexplode(grams(words(F.col("text")))).alias("pos", "gram"))
    hits = rolling.join(positions, "gram")
    diagonals = hits.groupBy("key", "template", "errors", "needed", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.count(F.lit(1)).alias("votes"))
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("errors"), F.lit(True))
    merged = diagonals.withColumn("apart", apart.cast("int")).withColumn("band", F.sum("apart").over(along))
    found = merged.groupBy("key", "template", "band").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes"), F.first("needed").alias("needed"))
    return found.filter("votes >= needed").select("key", "template", "low", "high")


def verified(text: str, found: Iterable[dict], sought: list[Sought]) -> list[dict]:
    """The places in a text's bands that match their templates, in order and once each."""
    whole = words_of(text)
    places: dict[int, set[tuple[int, int, int]]] = {}
    for band in found:
        s = sought[band["template"]]
        start = max(band["low"] - s.errors, 0)
        seen = s.places(whole[start : max(band["high"] + len(s.words) + s.errors, start)])
        places.setdefault(s.number, set()).update((errors, start + first, start + end) for first, end, errors in seen)
    spans = []
    for number, some in places.items():
        s, taken = sought[number], []
        # of places that share words the one with the fewest errors, where errors are allowed
        for errors, first, end in sorted(some):
            if s.errors and any(first < other and end > start for start, other in taken):
                continue
            taken.append((first, end))
            spans.append({"label": s.label, "template": number, "base": s.base, "first_word": first, "last_word": end - 1, "errors": errors, "score": max(1 - errors / len(s.words), 0.0)})
    return sorted(spans, key=lambda p: (p["first_word"], p["template"]))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, spans) of all documents: a span is (label, template, base, first_word, last_word, errors, score).

    docs has doc_id and text. A null text is empty: no words, no spans. Null identifiers and repeated rows are rows like
    others. A text is looked at as a whole, however long; a span that errors make ambiguous starts as late as it can.
    """
    sought = compiled(templates)
    text = shared.text_of("text")
    # equal rows have equal spans, so a digest of the row is its key
    key = F.unhex(F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), text).cast("binary"), 256))
    rows = docs.select("doc_id", text.alias("text"), key.alias("key"))
    found = bands(rows.select("key", "text"), sought).groupBy(F.col("key").alias("of_key")).agg(F.collect_list(F.struct("template", "low", "high")).alias("bands"))
    found = shared.written(found, "license-bands")
    fetched = shared.likely(rows.select("key", "text"), "key", found, "of_key").join(found, F.col("key") == F.col("of_key"))
    span = ", ".join(":".join(c.split()) for c in SPAN.split(", "))
    kind = pa.struct([("label", pa.string()), ("template", pa.int32()), ("base", pa.bool_()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32()), ("score", pa.float64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [verified(t.as_py(), b.as_py(), sought) for t, b in zip(batch.column("text"), batch.column("bands"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("of_key"), pa.array(spans, pa.list_(kind))], names=["of_key", "spans"])

    checked = shared.map_arrow(fetched.select("of_key", "text", "bands"), verify, f"of_key binary, spans array<struct<{span}>>")
    checked = shared.written(checked.filter(F.size("spans") > 0).dropDuplicates(["of_key"]), "license-spans")
    counted = rows.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), "key")
    return counted.join(checked, F.col("key") == F.col("of_key"), "left").select("doc_id", "n_words", F.coalesce("spans", F.array().cast(f"array<struct<{span}>>")).alias("spans"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the whole table ``documents``: the base phrases, other notices and licence texts."""
    found = scan(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["base"])
    labels = lambda s: F.array_join(F.array_sort(F.array_distinct(s["label"])), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first_word"]).alias("first_word"),
        F.array_max(base["first_word"]).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(spans).alias("labels"),
        F.coalesce(F.array_max(spans["score"]), F.lit(0.0)).alias("score"),
        F.size(spans).cast("long").alias("n_spans"),
    )

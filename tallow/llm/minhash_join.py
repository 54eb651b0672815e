"""Near-duplicate detection: an inverted join over MinHash signature coordinates, confirmed on full shingle sets.

1. Every text gets its set of shingle hashes and a signature of COORDINATES minima. Texts with one set are one class;
   one of them represents it from here on.
2. Representatives are posted under each coordinate-value pair. A pair that is alone in the corpus can't collide;
   a representative with fewer than `matches` shared ones is skipped for good.
3. Prefix: sorted by how many post them, rare ones first, two signatures that agree in `matches` coordinates must
   share one of the first COORDINATES - matches + 1. Only those stay posted.
4. Every list pairs its members with one of them, the pivot: the one whose coordinates most others share, as the text
   has from which the others were made. Collisions of a pair are counted over all coordinates; pairs with `matches`
   or more are compared on their full sets and linked. Lists whose members the links don't yet join do so again, with
   a pivot outside of their largest component, PIVOTS times in all.
5. What stays open: in each list, the members outside of its largest component meet the whole list, in blocks. Members
   within the largest component, nearly all of a large group, don't meet one another. Blocks first meet by signatures:
   a pair that no link joins counts in its first common list alone, under the same count of collisions and a longer
   sketch of SKETCH bytes. Only members that a pair is left for bring their full sets, so each pair of a list is either
   joined already, ruled out, or compared once.
6. Components follow by passing the smallest identifier along the links, with pointer jumping.

`matches` lies 4.3 standard deviations below what a pair right at the threshold shows, so a few such pairs in 100,000
are missed; pairs above it are missed still less often. The sketch adds less than one in a hundred million. All that is reported has been confirmed exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import shared

COORDINATES, SPREAD = 64, 4.3
#: Bytes of the longer signature that pairs of open lists must agree in, and standard deviations allowed below the threshold.
SKETCH, SKETCH_SPREAD = 512, 6.0
#: Rounds of pivots.
PIVOTS = 1
#: In lists that pivots leave open: members outside of the largest component in a block, members of the whole list, and their shingles.
OUTSIDE, BLOCK, BLOCK_SHINGLES = 512, 512, 500_000
#: Texts of a block that are compared at once.
TILE = 256
#: Bits of the filter that keeps texts nobody asks for out of a shuffle; 4 MB when it is full.
FILTER_BITS = 1 << 25
#: Shingle hashes that meet all coordinates at once, pairs whose signatures and whose sketches do; all bound memory.
CHUNK, CELLS, PAIRS = 8192, 16384, 32768


def least_matches(percent: int, coordinates: int = COORDINATES, spread: float = SPREAD) -> int:
    """Coordinates in which a pair right at the threshold agrees, less ``spread`` standard deviations."""
    p = percent / 100
    return max(1, int(coordinates * p - spread * (coordinates * p * (1 - p)) ** 0.5))


def _hashes(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of n hash functions."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


_SIGNATURE, _SKETCH = _hashes(20, COORDINATES), _hashes(21, SKETCH)


class Shingler:
    """Sets of shingle hashes of texts."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the runs of ``width`` words; of a shorter text, the one of all its words; none of no words."""
        words = shared.words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        width = min(self.width, len(words))
        # a shorter text differs from any shingle by its width
        out = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k : len(h) - width + 1 + k]
        return np.unique(out ^ (out >> np.uint64(32)))


def minima(shingles: np.ndarray, hashes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each hash function the smallest of the shingles' values."""
    multiply, add = hashes
    low = np.full(len(add), np.iinfo(np.uint32).max, np.uint32)
    step = CHUNK * COORDINATES // len(add)
    for k in range(0, len(shingles), step):
        x = shingles[k : k + step, None] * multiply + add
        low = np.minimum(low, (x >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return low


def signature(shingles: np.ndarray) -> np.ndarray:
    return minima(shingles, _SIGNATURE).view(np.int32)


def sketch(shingles: np.ndarray) -> bytes:
    """A byte of each of SKETCH minima: sets agree in at least the share of bytes that their similarity makes likely."""
    return minima(shingles, _SKETCH).astype(np.uint8).tobytes()


def text_key(text_col: str) -> Column:
    return F.xxhash64(shared.text_of(text_col))


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, row, key, n_shingles, digest, sig); digest is null where there are no words."""
    names = ["doc_id", "row", "key", "n_shingles", "digest", "sig"]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sizes, digests, sigs = [], [], []
                for text in part.column(3):
                    s = shingler(text.as_py())
                    sizes.append(len(s))
                    digests.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    sigs.append(signature(s) if len(s) else None)
                columns = [*part.columns[:3], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("long"), F.monotonically_increasing_id(), text_key(text_col), shared.text_of(text_col))
    return shared.written(shared.map_arrow(rows, signed, "doc_id long, row long, key long, n_shingles long, digest binary, sig array<int>"), "signatures")


def postings(reps: DataFrame, matches: int) -> DataFrame:
    """Rows (token, doc, n_shingles, length, weight, popular) of prefix coordinates that are shared.

    length and weight are the texts and the shingles of the token's list, popular the sum of the lengths of all the
    doc's lists.
    """
    token = F.transform("sig", lambda v, k: F.shiftleft(k.cast("long"), 32).bitwiseOR(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
    posted = reps.select("doc", "n_shingles", F.explode(token).alias("token"))
    lists = posted.groupBy("token").agg(F.count(F.lit(1)).alias("length"), F.sum("n_shingles").alias("weight")).filter("length > 1")
    shared_tokens = posted.join(lists, "token").groupBy("doc").agg(F.first("n_shingles").alias("n_shingles"), F.array_sort(F.collect_list(F.struct("length", "token", "weight"))).alias("tokens"), F.sum("length").alias("popular"))
    kept = shared_tokens.filter(F.size("tokens") >= matches)
    # coordinates that nobody shares come first in the prefix and need no posting
    prefix = kept.select("doc", "n_shingles", "popular", F.explode(F.slice("tokens", 1, F.size("tokens") - (matches - 1))).alias("t"))
    return shared.written(prefix.select(F.col("t.token").alias("token"), "doc", "n_shingles", F.col("t.length").alias("length"), F.col("t.weight").alias("weight"), "popular"), "postings")


def pivot_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a < b) of each list's pivot with the members that no link joins it with.

    The pivot is the most popular member outside of the largest component; of equally popular ones the smallest.
    """
    pivots = lists.filter("outside").groupBy("token").agg(F.min(F.struct(-F.col("popular"), "doc", "root")).alias("p")).select("token", F.col("p.doc").alias("pivot"), F.col("p.root").alias("pivot_root"))
    # as a table, so that the join has a shuffle of its own, whose long lists Spark can split
    pivots = shared.written(pivots, "pivots")
    met = lists.select("token", "doc", "root").join(pivots, "token").filter("root != pivot_root")
    return met.select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct()


def unjoined(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of lists that still have members of several components, with roots anew.

    outside tells whether a row is outside of the largest component of its list, n_outside how many are, and
    outside_weight how many shingles these have. A list of two is done after one pivot.
    """
    placed = lists.filter("length > 2").select("token", "doc", "n_shingles", "length", "weight", "popular").join(roots.withColumnRenamed("node", "doc"), "doc", "left")
    placed = placed.withColumn("root", F.coalesce("root", "doc"))
    parts = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    several = parts.groupBy("token").agg(F.max(F.struct("n", "root", "w")).alias("top"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    outside = [(F.col(c) - F.col(f"top.{c}")).alias(name) for c, name in (("n", "n_outside"), ("w", "outside_weight"))]
    several = shared.written(several.select("token", F.col("top.root").alias("main"), *outside), "several")
    return shared.written(placed.join(several, "token").withColumn("outside", F.col("root") != F.col("main")).drop("main"), "open-lists")


def colliding(pairs: DataFrame, reps: DataFrame, matches: int) -> DataFrame:
    """The pairs whose signatures agree in enough coordinates."""
    sig = reps.select("doc", "sig")
    both = pairs.join(sig.withColumnsRenamed({"doc": "a", "sig": "sig_a"}), "a").join(sig.withColumnsRenamed({"doc": "b", "sig": "sig_b"}), "b")
    equal = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return shared.written(both.filter(equal >= matches).select("a", "b"), "pairs")


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str, sketched: bool = False) -> DataFrame:
    """Rows (doc, shingles, sketch) for the wanted (doc, id, digest): sets are made again from the texts, not kept for all.

    Texts are found by identifier and taken where their set has the digest. The sketch is null where nobody asks for it.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [shingler(t.as_py()) for t in part.column(2)]
                same = [hashlib.md5(s.tobytes()).digest() == d.as_py() for s, d in zip(sets, part.column(1), strict=True)]
                sketches = [sketch(s) if sketched else None for s in sets]
                columns = [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(sketches, pa.binary())]
                found = pa.RecordBatch.from_arrays(columns, ["doc", "shingles", "sketch"])
                yield found.filter(pa.array(same, pa.bool_()))

    texts = docs.select(F.col(id_col).cast("long").alias("text_id"), shared.text_of(text_col).alias("text"))
    texts = _likely(texts, wanted)
    rows = texts.join(wanted, F.col("text_id").eqNullSafe(F.col("id"))).select("doc", "digest", "text")
    # repeated rows give a set again
    return shared.written(shared.map_arrow(rows, made, "doc long, shingles binary, sketch binary").dropDuplicates(["doc"]), "shingle-sets")


def _likely(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose identifier may be wanted, by one bit of its hash: what is broadcast has a fixed largest size."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    bitmaps = wanted.groupBy(F.bitmap_bucket_number(bit("id")).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit("id"))).alias("bits"))
    place = F.bitmap_bit_position(bit("text_id"))
    byte = F.conv(F.hex(F.substr("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    near = texts.join(F.broadcast(bitmaps), F.bitmap_bucket_number(bit("text_id")) == F.col("bucket"))
    return near.filter(F.getbit(byte, (place % 8).cast("int")) == 1).select(texts.columns)


def confirmed_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity asked for."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], ["a", "b"])

    left = pairs.join(sets.withColumnsRenamed({"doc": "a", "shingles": "sa"}), "a")
    both = left.join(sets.withColumnsRenamed({"doc": "b", "shingles": "sb"}), "b").select("a", "b", "sa", "sb")
    return shared.map_arrow(both, compare, "a long, b long")


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Matrix of left by right: whether two sets are similar enough. Works on slices of the shingles, so memory is bounded."""
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times[code] > 1
    owner, code = owner[often], code[often]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        a, b = np.searchsorted(code, [lo, lo + 4096])
        there = np.zeros((len(sets), 4096), np.float32)
        there[owner[a:b], code[a:b] - lo] = 1
        common += there[: len(left)] @ there[len(left) :].T
    n, m = (np.array([len(s) for s in x], np.float64) for x in (left, right))
    return 100 * common >= percent * (n[:, None] + m - common)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links, each tree as a star around its smallest member."""
    root = {int(x): int(x) for x in np.concatenate([a, b])}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(find(x), x) for x in root if find(x) != x]


class Block:
    """The rows of one list that meet: those that ask, and those that are asked."""

    def __init__(self, rows: pd.DataFrame, matches: int):
        self.doc, self.root, self.outside = (rows[c].to_numpy() for c in ("doc", "root", "outside"))
        self.bits = (rows["open"].to_numpy()[:, None] >> np.arange(COORDINATES) & 1).astype(bool)
        self.sig = np.stack(rows["sig"].to_list())
        self.coordinate, self.matches = int(rows["token"].iloc[0]) >> 32, matches
        asks = rows["asks"].to_numpy()
        self.asking, self.asked = np.flatnonzero(asks), np.flatnonzero(~asks)

    def tiles(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows that ask, rows asked, and a matrix of the pairs that this list has to compare."""
        for lo in range(0, len(self.asked) if len(self.asking) else 0, TILE):
            x, y = self.asking, self.asked[lo : lo + TILE]
            wanted = self.wanted(x, y)
            x, y, wanted = x[wanted.any(axis=1)], y[wanted.any(axis=0)], wanted[wanted.any(axis=1)][:, wanted.any(axis=0)]
            if len(x):
                yield x, y, wanted

    def wanted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs that no link joins and that collide often enough; each only in its first common list, and there once.

        Two texts in a list share its coordinate's value, so their common lists follow from their signatures and the
        coordinates of which each has an open list.
        """
        # where both ask, the smaller does
        wanted = (self.root[x][:, None] != self.root[y]) & ~(self.outside[y] & (self.doc[x][:, None] > self.doc[y]))
        c = self.coordinate
        step = max(1, CELLS // max(1, len(y)))
        for lo in range(0, len(x), step):
            at = x[lo : lo + step]
            equal = self.sig[at][:, None] == self.sig[y]
            wanted[lo : lo + step] &= equal.sum(axis=2) >= self.matches
            before = equal[:, :, :c] & self.bits[at][:, None, :c] & self.bits[y][:, :c]
            wanted[lo : lo + step] &= ~before.any(axis=2)
        return wanted


def meetings(lists: DataFrame) -> DataFrame:
    """Rows (token, i, j, doc, root, outside, asks, open): in every block (i, j) of a list, the members that ask and those asked.

    Both sides are bounded by texts and by shingles. open has a bit for each coordinate of which the text has an open list.
    """
    chunks = F.ceil(F.greatest(F.col("n_outside") / OUTSIDE, F.col("outside_weight") / BLOCK_SHINGLES)).cast("int")
    blocks = F.ceil(F.greatest(F.col("length") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("int")
    number = lambda n: F.pmod(F.xxhash64("doc"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    coordinates = lists.groupBy("doc").agg(F.bit_or(F.expr("shiftleft(1L, int(shiftright(token, 32)))")).alias("open"))
    rows = lists.join(coordinates, "doc")
    left = rows.filter("outside").select("token", number(chunks).alias("i"), every(blocks).alias("j"), "doc", "root", "outside", F.lit(True).alias("asks"), "open")
    right = rows.select("token", every(chunks).alias("i"), number(blocks).alias("j"), "doc", "root", "outside", F.lit(False).alias("asks"), "open")
    return left.unionByName(right)


def left_over(met: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """The rows of meetings for which signatures and sketches leave a pair."""
    least = least_matches(percent, SKETCH, SKETCH_SPREAD)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), SKETCH)
        stays = np.zeros(len(rows), bool)
        for x, y, wanted in Block(rows, matches).tiles():
            p, q = (v[at] for v, at in zip((x, y), np.nonzero(wanted), strict=True))
            for lo in range(0, len(p), PAIRS):
                a, b = p[lo : lo + PAIRS], q[lo : lo + PAIRS]
                alike = (sketches[a] == sketches[b]).sum(axis=1) >= least
                stays[a[alike]] = stays[b[alike]] = True
        return rows.loc[stays, columns]

    columns = met.columns
    shared.ship(met.sparkSession)
    whole = met.join(sets.select("doc", "sketch"), "doc").join(reps.select("doc", "sig"), "doc")
    return shared.written(whole.groupBy("token", "i", "j").applyInPandas(meet, met.schema), "meetings")


def open_links(lists: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """Links (a, b) within open lists: a spanning forest of what is confirmed between each two blocks of a list."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows, matches)
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        edges = []
        for x, y, wanted in block.tiles():
            p, q = np.nonzero(linked([sets[k] for k in x], [sets[k] for k in y], percent) & wanted)
            edges += _forest(block.doc[x[p]], block.doc[y[q]])
        found = _forest(*np.array(edges, np.int64).reshape(-1, 2).T)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rest = left_over(meetings(lists), reps, sets, percent, matches)
    whole = rest.join(sets.select("doc", "shingles"), "doc").join(reps.select("doc", "sig"), "doc")
    return whole.groupBy("token", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Rows (node, root): for each node of a link the smallest node that it reaches.

    ``before`` has the components (node, root) of links given earlier. Every round a node takes the smallest label among
    its neighbours', then the label of that label. The loop ends when nothing changes, so its rounds follow the
    links' structure, and each round's table is written, so none is repeated.
    """
    if before is not None:
        if links.isEmpty():
            return before
        links = links.unionByName(before.filter("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    both = shared.written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = shared.written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("root").alias("jump"))
        changes = Observation()
        after = low.join(up, "low").select("node", F.least("low", "jump").alias("next"), "root")
        after = shared.written(after.observe(changes, F.count_if(F.col("next") < F.col("root")).alias("n")), "labels")
        labels = after.select("node", F.col("next").alias("root"))
        if not changes.get["n"]:
            return labels


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    width: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    matches: int | None = None,
) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept, key (a short hash of the text).

    A text's set holds its distinct shingles of ``width`` words (lower-cased A-Z); with fewer words, all of them as
    one; without words, or null, it is empty and linked with nothing. Texts are linked where 100 * intersection >=
    percent * union; component_id is the smallest identifier that can be reached, kept where it is the row's own. Of
    repeated rows with one identifier the first read is kept. A row with a null identifier is larger than all others
    in its class, and alone it has no component_id and stays. An empty table gives an empty result; other columns are ignored.
    """
    sigs = signatures(docs, width, id_col, text_col)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    # a signature follows from the set, so any of a class will do
    classes = shared.written(sigs.filter("digest IS NOT NULL").groupBy("digest").agg(best, F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("copies")), "set-classes")
    # a class goes by the row of its best member from here on
    reps = classes.select(F.col("best.row").alias("doc"), F.col("best.doc_id").alias("id"), "digest", "n_shingles", "sig")
    matches = least_matches(percent) if matches is None else matches
    lists = postings(reps, matches).withColumns({"root": F.col("doc"), "outside": F.lit(True)})
    named = reps.select("doc", "id", "digest")

    def sets_of(wanted: DataFrame, sketched: bool = False) -> DataFrame:
        return shingle_sets(docs, shared.written(wanted.distinct().join(named, "doc"), "wanted"), width, id_col, text_col, sketched)

    roots: DataFrame | None = None
    for _ in range(PIVOTS):
        pairs = colliding(pivot_pairs(lists), reps, matches)
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc")))
        roots = components(shared.written(confirmed_pairs(pairs, sets, percent), "confirmed"), roots)
        lists = unjoined(lists, roots)
    more = open_links(lists, reps, sets_of(lists.select("doc"), True), percent, matches)
    roots = components(shared.written(more, "confirmed"), roots)
    # down again: components get their best row, then the classes, then the rows of those that aren't alone
    placed = classes.join(roots, F.col("best.row") == F.col("node"), "left").select("digest", "best", "copies", F.coalesce("root", "best.row").alias("root"))
    heads = shared.written(placed.groupBy("root").agg(F.min("best").alias("head"), F.sum("copies").alias("members")).filter("members > 1"), "heads")
    named = placed.join(heads, "root").select("digest", "head")
    return sigs.join(named, "digest", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("head.row"), F.lit(True)).alias("kept"),
        "key",
    )


def drop_near_copies(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near copies, all columns as they are."""
    return shared.keep_decided(docs, near_duplicates(docs, percent, width, id_col, text_col), text_key(text_col), id_col)


def op9_minhash_join(spark, sf_dir):
    return near_duplicates(shared.table(spark, sf_dir, "documents")).drop("key")

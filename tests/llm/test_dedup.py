from __future__ import annotations

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from tallow import scratch
from tallow.llm import exact_dedup, minhash_join, registry, shared
from tests.conftest import SF
from tests.llm.common import ROWS, docs


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact(spark):
    got = exact_dedup.exact_dedup(docs(spark), fan_in=2).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for i, t in ROWS:
        groups.setdefault(normal(t), []).append(i)
    by_digest = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        members = by_digest[r.text_sha256]
        ids = [m for m in members if m is not None]
        assert r.group_size == len(members) and r.keep_id == (min(ids) if ids else None)
        if members.count(r.doc_id) == 1:
            assert r.kept == (r.doc_id == r.keep_id)
    assert sum(r.kept for r in got) == len(groups)


def test_exact_tree(spark):
    """Many runs, a group that holds a third of all rows, every fan-in."""
    rows = [(k, "hot" if k % 3 == 0 else f"text {k // 2}") for k in range(300)]
    df = docs(spark, rows).repartition(13)
    for fan_in in (2, 3, 16):
        got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(df, fan_in=fan_in).collect()}
        assert got[297] == (0, 100) and got[1] == (1, 1) and got[5] == (4, 2)


def test_merged_pieces_are_sorted_and_small(spark):
    rows = [(k, f"text {k % 500}") for k in range(2000)]
    runs = exact_dedup.digest_runs(docs(spark, rows).repartition(8)).filter("digest IS NOT NULL")
    folded, merged = exact_dedup.merge_runs(runs, 2)
    assert folded.groupBy("run").count().count() == 8
    assert merged.agg(F.count("*"), F.sum("copies"), F.max("run")).first()[:] == (500, 2000, 0)
    pieces = exact_dedup.merged_pieces(folded, F.floor(F.col("run") / 2), 4).withColumn("task", F.spark_partition_id()).collect()
    for _, piece in itertools.groupby(pieces, lambda r: r.task):
        at = [(r.run, r.range, bytes(r.digest)) for r in piece]
        assert at == sorted(at)
    assert all(r.range == r.digest[0] >> 6 for r in pieces)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4  # one for each level of the tree, none for folding


def test_exact_empty(spark):
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0
    assert exact_dedup.drop_copies(docs(spark, [])).count() == 0


def test_drop_copies_keeps_columns(spark):
    df = docs(spark)
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 3, 5, 6, 8, 9, 10, 12, 14]


def brute_components(rows, percent, width):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return [(rows[k][0], len(sets[k]), least(groups[find(k)])) for k in range(len(rows))]


def check_near(spark, rows, percent=85, width=3):
    got = minhash_join.near_duplicates(docs(spark, rows), percent, width).collect()
    expected = brute_components(rows, percent, width)
    show = lambda x: sorted(x, key=str)
    assert show((r.doc_id, r.n_shingles, r.component_id) for r in got) == show(expected)
    return got


def test_near_edges(spark):
    got = check_near(spark, ROWS)
    assert sum(r.kept for r in got if r.doc_id == 12) == 1
    assert all(r.kept for r in got if r.doc_id in (3, 4, 5, None))
    assert minhash_join.near_duplicates(docs(spark, [])).count() == 0


def test_near_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.QUERIES["op9_minhash_join"](spark, SF).collect()
    expected = brute_components(rows, 85, 3)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(expected)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and sum(r.kept for r in got) < len(rows)


def test_near_large_group(spark):
    """A group of near copies at all distances, longer than a list that gives its pairs, and pairs around the threshold."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(rng.randrange(0, 8)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    for k in range(100, 160):
        words = [f"y{rng.randrange(10**6)}" for _ in range(60)]
        rows.append((k, " ".join(words)))
        words[rng.randrange(60)] = "changed"
        words[rng.randrange(60)] = "changed"
        rows.append((k + 500, " ".join(words)))
    check_near(spark, rows)
    check_near(spark, rows, 80, 5)


def test_near_long_lists_in_blocks(spark, monkeypatch):
    """Block pairs meet every pair of a list."""
    monkeypatch.setattr(minhash_join, "BLOCK", 7)
    monkeypatch.setattr(minhash_join, "OUTSIDE", 5)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join([*base[: 80 - k % 5], f"end{k}"])) for k in range(40)]
    check_near(spark, rows)


def test_near_template_meets_a_pair_once(spark):
    """Texts of one template that aren't alike enough: many open lists with the same members."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(400):
        words = list(base)
        for at in rng.sample(range(300), 9):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    df = docs(spark, rows)
    sigs = minhash_join.signatures(df, 3, "doc_id", "text")
    reps = sigs.select(F.col("row").alias("doc"), F.col("doc_id").alias("id"), "digest", "n_shingles", "sig")
    matches = minhash_join.least_matches(85)
    nothing = spark.createDataFrame([], "node long, root long")
    lists = minhash_join.unjoined(minhash_join.postings(reps, matches), nothing)
    met = minhash_join.meetings(lists)
    sets = minhash_join.shingle_sets(df, reps.select("doc", "id", "digest"), 3, "doc_id", "text", True)
    assert lists.groupBy("token").count().filter("count > 100").count() > 10

    def pairs_of(group):
        import pandas as pd

        block = minhash_join.Block(group, 1)
        found = [(block.doc[x[p]], block.doc[y[q]]) for x, y, wanted in block.tiles() for p, q in zip(*wanted.nonzero(), strict=True)]
        return pd.DataFrame([sorted(map(int, pair)) for pair in found], columns=["a", "b"], dtype="int64")

    compared = met.join(reps.select("doc", "sig"), "doc").groupBy("token", "i", "j").applyInPandas(pairs_of, "a long, b long").cache()
    together = lists.select("token", "doc").alias("l").join(lists.select("token", "doc").alias("r"), F.expr("l.token = r.token AND l.doc < r.doc")).select("l.doc", "r.doc").distinct().count()
    assert compared.count() == compared.distinct().count() == together  # each pair of a list, once
    assert minhash_join.left_over(met, reps, sets, 85, matches).count() < 10 * len(rows)
    check_near(spark, rows)


def test_asking_side_is_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "BLOCK_SHINGLES", 1000)
    lists = spark.createDataFrame(
        [(5 << 32, k, 600, 600 * 40, 600 * 40, k, k > 0, 40, 39, 600 * 39) for k in range(40)],
        "token long, doc long, n_shingles long, weight long, popular long, root long, outside boolean, length long, n_outside long, outside_weight long",
    )
    sides = minhash_join.meetings(lists).groupBy("i", "j", "asks").agg(F.sum(F.lit(600)).alias("shingles"))
    assert sides.agg(F.max("shingles")).first()[0] <= 6 * 1000  # by hash, so about as many
    assert minhash_join.meetings(lists).select("open").distinct().collect()[0][0] == 1 << 5


def test_linked_tiles():
    import numpy as np

    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 6000, rng.integers(1, 5000)).astype(np.uint64)) for _ in range(9)]
    sets.append(sets[0][: int(len(sets[0]) * 0.9)])
    got = minhash_join.linked(sets, sets, 85)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * n >= 85 * (len(a) + len(b) - n))


def test_components(spark):
    chain = [(k, k + 1) for k in range(20)] + [(30, 31), (29, 31), (50, 51)]
    got = {r.node: r.root for r in minhash_join.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(21)} | {29: 29, 30: 29, 31: 29, 50: 50, 51: 50}


def test_drop_near_copies(spark):
    df = docs(spark)
    out = minhash_join.drop_near_copies(df, percent=50, width=3)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 3, 4, 5, 6, 8, 9, 10, 12]


def test_scratch_folder(spark):
    assert shared.written(spark.range(3), "t").count() == 3
    path = shared.written(spark.range(1), "t").select(F.input_file_name()).first()[0]
    assert path.startswith(scratch.application_dir(spark))

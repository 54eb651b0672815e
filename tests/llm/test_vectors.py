"""Vector codes and clusters against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallow.llm import centroid_clusters, registry, vector_codes, vectors
from tests.conftest import SF
from tests.llm.common import CLASHING
from tests.test_queries import same_rows

NAN, INF = float("nan"), float("inf")


def table(spark, rows, kind="float"):
    """vec_id, embedding, label, and extra columns whose names clash."""
    extra = (*CLASHING, "vector", "cells", "place", "code", "error", "cluster", "part", "entry")
    schema = f"vec_id long, embedding array<{kind}>, label int, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], schema).repartition(3)


def random_rows(n, width=64, seed=1):
    """A third of the rows is one vector; identifiers repeat, and some rows don't count."""
    rng = random.Random(seed)
    hot = [rng.gauss(0, 0.3) for _ in range(width)]
    rows = [(rng.randrange(n), list(hot) if k % 3 == 0 else [rng.gauss(0, 0.3) for _ in range(width)], rng.choice([None, 1, 2])) for k in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [NAN] + [0.0] * (width - 1), 1), (n + 3, [INF] + [0.0] * (width - 1), 1), (n + 4, [None] + [0.0] * (width - 1), 1)]
    return rows + [(None, [0.1] * width, None), (0, rows[0][1], 2), (0, rows[0][1], 2)]


def counted(rows, width=None):
    ok = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and (width is None or len(r[1]) == width)]
    # floats, as the table holds them
    return [(r[0], [float(np.float32(x)) for x in r[1]], r[2]) for r in ok]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 90), st.sampled_from([1, 3, 16]), st.sampled_from([2, 60, 1000, 2**24]))
def test_tree_gives_the_nearest_entry(seed, entries, width, most):
    """Also with ties, equal entries, and numbers whose distances doubles don't hold."""
    rng = np.random.default_rng(seed)
    book, queries = (rng.integers(-most, most, (n, width)) for n in (entries, 50))
    squares = np.stack([((queries - b) ** 2).sum(1) for b in book], axis=1)
    who, best = vector_codes.Tree(book, degree=3, leaf=4).nearest(queries)
    assert (who == squares.argmin(1)).all() and (best == squares.min(1)).all()
    assert (vectors.squared(queries, book) == squares).all()


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(5)
    centers = rng.integers(-5000, 5000, (12, 16))
    book = (centers[:, None, :] + rng.integers(-40, 40, (12, 20, 16))).reshape(-1, 16)
    queries = book[rng.integers(0, 240, 2000)] + rng.integers(-20, 20, (2000, 16))
    tree = vector_codes.Tree(book)
    tree.nearest(queries)
    assert tree.compared < 0.3 * len(queries) * len(book)


def brute_codes(rows, entries, rounds):
    rows = counted(rows)
    width = -(-max(len(r[1]) for r in rows) // 4)
    whole = np.array([[int(np.floor(1024 * x)) for x in r[1]] + [0] * (4 * width - len(r[1])) for r in rows])
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]
    parts = [whole[:, p * width : (p + 1) * width] for p in range(4)]
    books = [part[order] for part in parts]
    near = lambda part, book: np.array([[((q - b) ** 2).sum() for b in book] for q in part])
    for _ in range(rounds):
        new = []
        for part, book in zip(parts, books, strict=True):
            who = near(part, book).argmin(1)
            new.append(np.array([part[who == e].sum(0) // (who == e).sum() if (who == e).any() else b for e, b in enumerate(book)]))
        books = new
    squares = [near(part, book) for part, book in zip(parts, books, strict=True)]
    codes = ["".join(f"{s[k].argmin():02x}" for s in squares) for k in range(len(rows))]
    return [(r[0], r[2], c, sum(int(s[k].min()) for s in squares)) for k, (r, c) in enumerate(zip(rows, codes, strict=True))], books


def test_codes_against_brute_force(spark):
    rows = random_rows(150)
    want, want_books = brute_codes(rows, 20, 3)
    df = table(spark, rows)
    books = vector_codes.train(df, entries=20, rounds=3)
    assert all((a == b).all() for a, b in zip(books, want_books, strict=True))
    got = vector_codes.with_label_error(vector_codes.encode(df, books)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.label_error == sum(e for _, label, _, e in want if label == r.label)
    assert len(vector_codes.decoded(got[0].code, books)) == 64


def test_codes_of_other_tables(spark):
    assert vector_codes.train(table(spark, [])) == []
    assert vector_codes.encode(table(spark, []), []).collect() == []
    assert vector_codes.train(table(spark, [(1, None, 1), (2, [NAN] * 4, None)])) == []
    # lengths that four doesn't divide, short and empty vectors, doubles
    rows = [(1, [0.5, -0.25, 1.0, 2.0, 3.0], 1), (2, [0.5], None), (3, [], 2), (3, [], 2)]
    df = table(spark, rows, "double")
    books = vector_codes.train(df)
    got = sorted((r.vec_id, r.error) for r in vector_codes.encode(df, books).collect())
    assert got == [(1, 0), (2, 0), (3, 0), (3, 0)] and books[0].shape == (4, 2)
    with pytest.raises(Exception, match="fit a long"):
        vector_codes.train(table(spark, [(1, [1e9] * 4, 1)]))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_centroid_clusters"])
def test_matches_sql(spark, duck, name):
    same_rows(registry.QUERIES[name](spark, SF), duck.sql(registry.ORACLE_SQL[name]))


def brute_clusters(rows, centroids, rounds):
    rows = counted(rows, 64)
    whole = np.array([[int(np.floor(64 * x)) for x in r[1]] for r in rows])
    digest = lambda i: "~" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest()
    now = whole[sorted(range(len(rows)), key=lambda k: (digest(rows[k][0]), list(whole[k])))[:centroids]]
    squares = lambda: np.stack([((whole - c) ** 2).sum(1) for c in now], axis=1)
    for _ in range(rounds):
        who = squares().argmin(1)
        now = np.array([whole[who == k].sum(0) // (who == k).sum() if (who == k).any() else c for k, c in enumerate(now)])
    return [(r[0], int(s.argmin()), int(s.min())) for r, s in zip(rows, squares(), strict=True)], now


@pytest.mark.parametrize("bits", [1, 6, 8])
def test_clusters_against_brute_force(spark, bits):
    rows = [*random_rows(200, seed=3), (7, [0.1] * 63, 1), (8, [], 1), (9, [40.0, -90.0] * 32, 1)]
    want, centers = brute_clusters(rows, 9, 3)
    found, centroids = centroid_clusters.centroid_clusters(table(spark, rows), centroids=9, bits=bits)
    assert (centroids == centers).all()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_clusters_of_other_tables(spark):
    for rows in ([], [(1, None, 1), (2, [0.5] * 3, 1)]):
        found, centroids = centroid_clusters.centroid_clusters(table(spark, rows))
        assert found.collect() == [] and len(centroids) == 0
    found, centroids = centroid_clusters.centroid_clusters(table(spark, [(1, [0.5] * 64, 1), (2, [-0.5] * 64, 1)], "double"))
    assert len(centroids) == 2 and sorted(r.distance for r in found.collect()) == [0, 0]


@pytest.mark.parametrize("bits", [1, 2, 5, 8])
def test_intervals_hold_the_distance(bits):
    rng = np.random.default_rng(bits)
    block = (rng.standard_normal((300, 10)) * [1, 2, 3, 5, 8, 13, 1, 1, 0, 40]).astype(np.int64)
    block[0, 3] = 5000
    first, last = centroid_clusters.cell_bounds(block.min(0), block.max(0), block.mean(0), block.std(0), bits)
    cells = centroid_clusters.cells_of(block, first)
    assert (centroid_clusters.unpacked(centroid_clusters.packed(cells, bits), bits, 10) == cells).all()
    place = np.arange(10)
    assert (first[place, cells] <= block).all() and (block <= last[place, cells]).all()
    centroids = block[:6] + 1
    tables, squares = centroid_clusters.Intervals(centroids, first, last), vectors.squared(block, centroids)
    for k in range(6):
        low = sum(tables.near[j][cells[:, j], k] for j in place)
        high = sum(tables.far[j][cells[:, j], k] for j in place)
        assert (low <= squares[:, k]).all() and (squares[:, k] <= high).all()
    fetched = []
    got = tables.assign(cells, lambda rows: fetched.append(len(rows)) or block[rows])
    assert (got == squares.argmin(1)).all() and (bits < 5 or sum(fetched) < 300)


def test_rounds_scan_the_approximations_alone(spark):
    rows = vectors.kept(spark.read.parquet(f"{SF}/embeddings.parquet"), "vec_id", components=64)
    made, first, last = centroid_clusters.approximated(rows, 64, 64, 6)
    start = centroid_clusters._start(made, 16)
    old, new = (centroid_clusters.Intervals(c, first, last) for c in (start, start + 1))
    plan = centroid_clusters.unsettled(made, old, new, 6)._jdf.queryExecution().executedPlan().toString()
    assert "cells" in plan and "vector#" not in plan
    # where nothing can have moved, nothing is fetched but what is open
    same = centroid_clusters.unsettled(made, old, old, 6).count()
    assert same == int((old.candidates(centroid_clusters.unpacked(np.array([list(r.cells) for r in made.select("cells").collect()], dtype=np.uint8), 6, 64)).sum(1) > 1).sum())

"""Hard negatives and nearest neighbours against brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from ledgerloom.llm import hard_negatives, hnsw
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, text string, score double, rank int, dim int, tile int, v int, block int"
EXTRA = ("t", 0.5, 1, 2, 3, 4, 5)


def vectors(spark, seed=5, count=400, dim=8):
    """Clustered vectors, copies of one, scaled copies, zeros, other dimensions, nulls and non-finite components, repeated ids."""
    rng = random.Random(seed)
    f32 = lambda xs: [float(np.float32(x)) for x in xs]
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(i, f32(c + rng.gauss(0, 0.7) for c in rng.choice(centres)), rng.randrange(4)) for i in range(count)]
    hot = f32([0.5, 0.25, *[0.125] * (dim - 2)])
    rows += [(i, hot, i % 3) for i in range(count, count + 150)]
    n = len(rows)
    rows += [(n + i, [2 * x for x in rows[i][1]], 1) for i in range(6)]
    rows += [(n + 6, [0.0] * dim, 1), (n + 7, [0.0] * dim, 2), (n + 8, [], 1), (n + 9, [], 2), (n + 10, f32([1, 2, 3]), 0), (n + 11, f32([3, 2, 1]), 1)]
    rows += [(n + 12, None, 1), (n + 13, hot, None), (n + 14, [*hot[:-1], None], 1), (n + 15, [*hot[:-1], float("nan")], 1),
             (n + 16, [*hot[:-1], float("inf")], 1), (None, hot, 1), (3, hot, 2), rows[4], (50, None, 1)]
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA), rows


def taking_part(rows):
    return [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def brute_negatives(rows):
    known = {}
    for i, x, label in taking_part(rows):
        if label is None:
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        v = [math.floor(256 * c) for c in x]
        if i not in known or (label, v) < known[i]:
            known[i] = (label, v)
    out = []
    for a, (label, v) in known.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (_, w) in known.items() if i != a and len(w) == len(v))
        for ps, p in [s for s in scored if known[s[1]][0] == label][:5]:
            fits = [s for s in scored if known[s[1]][0] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps][:3]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def brute_nearest(rows, k=5):
    known = {}
    for i, x, _ in taking_part(rows):
        if any(x) and (i not in known or x < known[i]):
            known[i] = x
    out = {}
    for q, v in known.items():
        if q % 50:
            continue
        same = [(i, np.array(w)) for i, w in known.items() if i != q and len(w) == len(v)]
        scores = [(-float(hnsw.cosine(np.array([v]), w[None, :])[0]), i) for i, w in same]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


@pytest.fixture
def small_parts(monkeypatch):
    for name, value in (("TILE", 96), ("BUCKET", 32), ("SEARCH_BLOCK", 16), ("BATCH", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    for name, value in (("SHARD_NODES", 100), ("QUERY_BLOCK", 5), ("BATCH", 16)):
        monkeypatch.setattr(hnsw, name, value)


def anchor(vec_id):
    return vec_id % 50 == 0


def relabel(vec_id, label):
    from pyspark.sql import functions as F
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


@pytest.mark.parametrize("seed", [5, 6])
def test_negatives_against_all_pairs(spark, small_parts, seed):
    df, rows = vectors(spark, seed)
    got = hard_negatives.mine(df, anchor, relabel=relabel)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_negatives_of_a_table(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, SF).collect()))
    assert got == brute_negatives(rows) and got


def test_candidates_never_lose_a_row():
    rng = np.random.default_rng(1)
    pruned = 0
    for dim in (1, 2, 5, 16):
        # skewed coordinates and lengths, so that ranges and lengths prune; zero rows and anchors too
        rows = (rng.standard_normal((300, dim)) * rng.exponential(60, (300, 1)) * np.arange(1, dim + 1) ** -1.5).astype(np.int64)
        rows[-2:] = 0
        rows = rows[np.argsort(-np.abs(rows).sum(1))]
        anchors = (rng.standard_normal((40, dim)) * 90 * np.arange(1, dim + 1) ** -1.5).astype(np.int64)
        anchors[0] = 0
        units, lengths = hard_negatives._units(rows)
        au, al = hard_negatives._units(anchors)
        scores = anchors @ rows.T
        for _ in range(30):
            lo = np.quantile(scores, rng.random(40) ** 0.2 * 0.999, axis=1).diagonal().astype(np.int64)
            hi = np.maximum(lo + rng.integers(-5, 3000, 40), -9000)
            for b in range(0, 300, 100):
                own = units[b : b + 100].T.astype(np.float32)
                order = np.argsort(own, axis=1, kind="stable")
                places = np.empty(own.shape, np.int16)
                np.put_along_axis(places, order, np.arange(100, dtype=np.int16)[None, :], 1)
                mask = hard_negatives.candidates(au, al, lo.astype(float), hi.astype(float), lengths[b : b + 100], places, np.take_along_axis(own, order, 1))
                fits = (scores[:, b : b + 100] >= lo[:, None]) & (scores[:, b : b + 100] <= hi[:, None])
                assert not (fits & ~mask).any()
                pruned += (~mask).sum()
    assert pruned > 100_000


def test_nearest_against_all_pairs(spark, small_parts):
    # a shard has fewer nodes than a search keeps candidates: every connected node is found
    df, rows = vectors(spark)
    got = {}
    for r in hnsw.nearest(df, anchor).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = {q: found for q, found in brute_nearest(rows).items() if found}
    assert got == want and len(want) > 8


def test_recall_of_a_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table.collect()]
    want, got = brute_nearest(rows), {}
    for r in QUERIES["op12_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    found = sum(i in got[q] for q, near in want.items() for i, _ in near)
    assert found / sum(map(len, want.values())) >= 0.95
    exact = {(q, i): s for q, near in want.items() for i, s in near}
    assert all(exact[q, i] == s for q, near in got.items() for i, s in near.items() if (q, i) in exact)


def test_recall_of_large_graphs():
    rng = np.random.default_rng(7)
    for clustered in (False, True):
        x = rng.standard_normal((4000, 32))
        if clustered:
            x = x * 0.1 + rng.standard_normal((20, 32))[rng.integers(0, 20, 4000)]
        units = hnsw.unit(x)
        layers = hnsw.build_graph(units)
        assert [len(y) for y in layers] == hnsw.layer_sizes(4000)
        queries = units[::40]
        truth = np.argsort(-(queries @ units.T), axis=1, kind="stable")[:, :6]
        ids, _ = hnsw.search_layer(units, layers[0], queries, hnsw.descend(units, layers, queries, 0), hnsw.EF_SEARCH)
        assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(ids, truth)]) > 0.95


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(none, anchor).count() == 0 and hnsw.nearest(none, anchor).count() == 0
    alone = spark.createDataFrame([(50, [1.0, 2.0], 1, *EXTRA)], SCHEMA)
    assert hard_negatives.mine(alone, anchor).count() == 0 and hnsw.nearest(alone, anchor).count() == 0

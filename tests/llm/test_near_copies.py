import os
import random
import re

import numpy as np
import pytest
from cases import documents, empty

from ledgerloom.llm import common, graph, ngram_join
from ledgerloom.llm.common import LOWER, UPPER, WORD

FOLD = str.maketrans(UPPER, LOWER)


def shingles(text, n):
    w = re.findall(WORD, (text or "").translate(FOLD))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    """n_shingles and smallest doc_id of each row's component."""
    sets = [shingles(r[1], n) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0] is None, r[0] or 0, len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("n,percent,tile", [(3, 90, 2048), (5, 80, 4), (3, 60, 3)])
def test_components_against_all_pairs(spark, n, percent, tile):
    docs, rows = documents(spark)
    got = ngram_join.join(docs, n, percent, tile).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, n, percent)


def test_empty_table(spark):
    assert ngram_join.join(empty(spark)).count() == 0
    assert ngram_join.one_of_each(empty(spark)).count() == 0


def test_one_of_each_keeps_whole_rows(spark):
    docs, rows = documents(spark)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    blank = [r for r in rows if not shingles(r[1], 5)]
    groups = {c for _, _, n, c in brute(rows, 5, 80) if n}
    # the id 7 stands on two different texts, each a group of its own
    assert kept.count() == len(groups) + 1 + len(blank)


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (200, 200)], "a long, b long")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_star_family_whose_copies_only_link_to_the_original(spark):
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join(base)]
    for k in range(30):
        own = list(base)
        for j in range(3):
            own[(k * 6 + j * 61) % 200] = f"x{k}-{j}"
        texts.append(" ".join(own))
    order = texts[1:16] + texts[:1] + texts[16:]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(order)], "doc_id long, text string")
    for tile in (2048, 5):
        got = ngram_join.join(docs, 3, 90, tile).collect()
        assert {r.component_id for r in got} == {0}
    assert {x[3] for x in brute([(i, t) for i, t in enumerate(order)], 3, 90)} == {0}


def test_rows_that_share_a_few_n_grams_form_no_tentative_group(spark, monkeypatch):
    """Each document has a third of the next one's words: one chain, whose length grows with the table."""
    # in a small table every shared n-gram is a crowded one
    monkeypatch.setattr(ngram_join, "crowd_ranks", lambda docs, n: np.zeros(ngram_join.CELLS, np.int8))
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**9)}" for _ in range(80 * 41)]
    docs = spark.createDataFrame([(k, " ".join(words[80 * k : 80 * k + 120])) for k in range(40)], "doc_id long, text string")
    with common.recorded() as paths:
        got = ngram_join.join(docs, 5, 80).collect()
    assert {r.component_id for r in got} == set(range(40))
    written = [(os.listdir(x)[0], os.path.join(x, os.listdir(x)[0])) for x in (p.removeprefix("file://") for p in paths) if os.path.isdir(x)]
    assert spark.read.parquet(next(p for n, p in written if n == "shared")).count() > 20
    assert [spark.read.parquet(p).count() for n, p in written if n == "members"] == [0, 0]


def test_first_bitmaps_part_sets_that_share_little():
    rng = np.random.default_rng(3)
    for n in (60, 100, 128, 700, 1500):
        common_part = rng.integers(0, 2**63, n // 4, dtype=np.uint64)
        sets = [np.concatenate([common_part, rng.integers(0, 2**63, n - n // 4, dtype=np.uint64)]) for _ in range(20)]
        bits = [ngram_join.bitmap(s, ngram_join.width_of(n)).tobytes() for s in sets]
        a, b = np.triu_indices(20, 1)
        assert not ngram_join._may_link(bits, np.full(20, n), a, b, 80).any()


def test_no_link_is_lost_by_places():
    """Every linked pair passes at its first common n-gram."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        both = rng.choice(10_000, int(rng.integers(4, 60)), replace=False)
        a, b = (np.sort(np.concatenate([both, 10_000 + k * 10_000 + rng.choice(10_000, int(rng.integers(0, 12)), replace=False)])) for k in (0, 1))
        ranks = rng.permutation(40_000)  # the common order
        a, b = a[np.argsort(ranks[a])], b[np.argsort(ranks[b])]
        first = min(np.isin(a, b).argmax(), len(a)), min(np.isin(b, a).argmax(), len(b))
        linked = 100 * len(both) >= 80 * (len(a) + len(b) - len(both))
        size, place, one = np.array([len(a), len(b)]), np.array(first), np.array([0])
        assert ngram_join._places_allow(size, place, one, one + 1, 80)[0] or not linked

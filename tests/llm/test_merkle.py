"""The manifest against one built node by node."""

import hashlib
import zlib

import pytest
from cases import documents, empty

from ledgerloom.llm import merkle
from ledgerloom.llm.queries import QUERIES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    made = lambda r: H(*map(field, r))
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))

    def reduce(nodes):
        """Top node, and the path of (left, right) of each node."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for path, k in zip(paths, at):
                lo = k // 3 * 3
                path.append(("".join(level[lo:k]), "".join(level[k + 1 : lo + 3])))
            at, level = [k // 3 for k in at], [H(*level[i : i + 3]) for i in range(0, len(level), 3)]
        return level[0], paths

    subs, inner = [], {}
    for s in order:
        own = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, made(r)))
        top, paths = reduce([made(r) for r in own])
        subs.append(top)
        inner[s] = (own, top, paths)
    if not subs:
        return []
    root, outer = reduce(subs)
    out = []
    for s, above in zip(order, outer):
        own, top, paths = inner[s]
        for r, path in zip(own, paths):
            path = path + above
            node = made(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = made((*r[:4], r[4].replace("\n", "")))
            for left, right in path:
                node = H(left, node, right)
            out.append((r[0], made(r), top, root, H(*[a + b for a, b in path]), node, node == root))
    return out


def check(spark, df):
    want = brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()])
    got = merkle.manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    return want


@pytest.mark.parametrize("height", [1, 2, 5])
def test_against_every_node(spark, monkeypatch, height):
    # small superblocks make trees of several levels of them, over leaves and over sources
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "SPAN", 3**height)
    docs, _ = documents(spark)
    docs = docs.selectExpr("*", "'x' as node", "1 as pos", "2 as block", "'t' as tree", "3 as place")
    want = check(spark, docs)
    assert len(want) > 60 and any(w[-1] for w in want) and not all(w[-1] for w in want)
    # 29 sources of 1 to 29 documents
    rows = [(1000 * s + i, f"line\n{i}" if i % 2 else None, None, f"s{s}" if s else None, i) for s in range(29) for i in range(s + 1)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_sizes_around_a_superblock(spark):
    for n in (1, 2, 3, 4, 242, 243, 244, 730):
        rows = [(i, "a\nb" if i % 3 else "", "en", "one", 3) for i in range(n)]
        check(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_large_ids_and_sources_by_bytes(spark):
    rows = [(2**62 + i, "t\n", None, s, None) for i, s in enumerate(["z", "é", "Z", "", None, "+", "zz"])] + [(None, "n\n", None, "z", 1)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"))


def test_empty(spark):
    assert merkle.manifest(empty(spark)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    got = QUERIES["op13_merkle_manifest"](spark, sf)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))

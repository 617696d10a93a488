import hashlib

import pytest
from cases import documents, empty

from ledgerloom.llm import suffix_dedup


def brute(rows, length):
    """n_bytes, n_removed, n_spans and hash of what stays, a row for each row."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            seen[t[k : k + length]] = seen.get(t[k : k + length], 0) + 1
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        out.append((str(r[0]), len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return sorted(out)


@pytest.mark.parametrize("length,seed,hot", [(200, 50, 20_000), (40, 10, 20_000), (40, 10, 2), (30, 5, 0)])
def test_against_all_substrings(spark, length, seed, hot):
    docs, rows = documents(spark)
    got = suffix_dedup.dedupe(docs, ["doc_id", "key", "n"], True, length, seed, hot)
    assert got.columns == ["doc_id", "key", "n", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in got.collect())
    assert got == brute(rows, length)


def test_periodic_text_and_overlaps(spark):
    rows = [(0, "ab" * 300), (1, "x" * 199), (2, "y" * 200), (3, "y" * 200 + "z"), (4, "q" * 201), (5, "ä" * 100 + "!"), (6, "?" + "ä" * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in suffix_dedup.dedupe(docs, ["doc_id"]).collect())
    assert got == brute(rows, 200)


def test_empty_table(spark):
    assert suffix_dedup.dedupe(empty(spark), ["doc_id"]).count() == 0


def test_text_longer_than_one_piece(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    import random

    import numpy as np

    rng = random.Random(1)
    t = bytes(rng.choice(b"abc") for _ in range(900))
    data = np.frombuffer(t, np.uint8)
    lo, hi, at, _ = suffix_dedup.seeds(data, 40, 10)
    assert lo[0] == 0 and hi[-1] == 900 - 40 and (lo[1:] == hi[:-1] + 1).all()
    assert all(a <= p <= z + 30 for a, z, p in zip(lo, hi, at))
    # equal windows have their seed at the same place
    where = {}
    for a, z, p in zip(lo, hi, at):
        for w in range(a, z + 1):
            assert where.setdefault(t[w : w + 40], p - w) == p - w


def test_digests_are_written_in_small_batches(spark):
    """Whole texts go to Python a few at a time, also in the last step, and the caller's setting stays."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    docs, rows = documents(spark)
    got = suffix_dedup.dedupe(docs, ["doc_id"], False, 40, 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and spark.conf.get(limit) == before
    assert sorted((str(r.doc_id), *r[1:5]) for r in got.collect()) == [r[:5] for r in brute(rows, 40)]


def test_a_task_gives_a_segment_once():
    import pyarrow as pa

    hit = [{"lo": 0, "hi": 0, "at": 1, "fp": 7, "hot": False}]
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("at", pa.int32()), ("fp", pa.int64()), ("hot", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["abcd"]), pa.array([1], pa.int64()), pa.array([hit], kind)], ["text", "cid", "hits"])
    given = lambda: [b.column("seg").to_pylist() for b in suffix_dedup._segments(4)([batch] * 3)]
    assert given() == [[b"abcd"], [None], [None]]

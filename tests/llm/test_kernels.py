import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import common as c
from ledgerloom.llm.suffix_array import longest_matches, suffix_array


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])


TEXTS = ["", None, "one", " a  b\tc\nd ", "äöü ÄÖ x", "word\x1fword\x00 \x0b end", "a" * 3000, "x y " * 500, "end"]


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_words_are_those_of_the_pattern_and_stay_in_their_row(limit):
    data, offsets = c.texts_of(batch(TEXTS))
    got = []
    for lo, hi, part, off in c.chunks(data, offsets, limit):
        starts, ends, first = c.word_spans(part, off)
        words = [part[s:e].tobytes().decode() for s, e in zip(starts, ends)]
        got += [words[first[k] : first[k + 1]] for k in range(hi - lo)]
    assert got == [re.findall(c.WORD, t or "") for t in TEXTS]


def test_span_hashes_depend_on_the_bytes_alone():
    text = "aa b aa ccc b aa aab"
    data = np.frombuffer(text.encode(), np.uint8)
    for limit in (3, 1 << 20):
        starts, ends, _ = c.word_spans(data, np.array([0, len(data)]))
        hashes = c.span_hashes(data, starts, ends, limit)
        seen = {}
        for word, h in zip(text.split(), hashes):
            assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_no_collisions_among_short_strings():
    words = [f"{a}{b}" for a in range(300) for b in "abcdefgh"] + ["a" * k for k in range(1, 60)]
    text = " ".join(words).encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = c.word_spans(data, np.array([0, len(data)]))
    assert len(set(c.span_hashes(data, starts, ends).tolist())) == len(set(words))


def test_sliced_and_null_columns():
    data, offsets = c.texts_of(batch(["drop", None, "keep", "x"]).slice(1, 2))
    assert data.tobytes() == b"keep" and offsets.tolist() == [0, 0, 4]


def test_suffix_array_against_sorting():
    rng = random.Random(5)
    for turn in range(600):
        n, letters = rng.randint(0, 40), rng.choice([1, 2, 3, 5, 20])
        text = [rng.randrange(letters) for _ in range(n)]
        if turn % 3 == 0 and n:
            text = (text[: rng.randint(1, 5)] * 50)[:n]
        order = suffix_array(text)
        assert order == sorted(range(n), key=lambda i: text[i:])

        def common(i, j):
            k = 0
            while max(i, j) + k < n and text[i + k] == text[j + k]:
                k += 1
            return k

        assert longest_matches(text, order) == [max((common(i, j) for j in range(n) if j != i), default=0) for i in range(n)]


def test_hash_filter_finds_every_key(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 5, -7, 10**15)] + [(None,)], "k long")
    bitmap = c.hash_filter(keys, "k")
    bits = keys.select(c.filter_bit("k").alias("b")).toPandas()["b"].to_numpy()
    assert c.in_filter(bitmap, bits).all()
    others = spark.range(1000, 3000).select(c.filter_bit("id").alias("b")).toPandas()["b"].to_numpy()
    assert c.in_filter(bitmap, others).sum() < 5


@pytest.mark.parametrize("n", [0, 1, 5, c.CHUNK_BYTES + 1, c.CHUNK_BYTES + 9])
def test_powers_are_kept_for_a_chunk_and_right_for_any_length(n):
    got = c.powers(c.BASE, n)
    assert len(got) == n and (n < 1 or got[0] == 1) and (got[1:] == got[:-1] * c.BASE).all()
    assert np.shares_memory(c.powers(c.BASE, 9), c.powers(c.BASE, 5))


def test_one_entry_of_a_log_softmax_is_the_same_bits():
    from ledgerloom.llm import lm_scoring
    rng = np.random.default_rng(3)
    x, at = rng.normal(0, 4, (300, 32)).astype(np.float32), rng.integers(0, 32, 300)
    want = lm_scoring._log_softmax(x)[np.arange(300), at]
    assert (lm_scoring._log_softmax_at(x.copy(), at) == want).all()

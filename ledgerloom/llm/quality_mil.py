"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded
by a small network over surface statistics (symbols, case, digits, line
breaks, word lengths, repetition), gated attention weighs the passages,
and the weighted sum is scored. Only documents have labels; the attention
learns which passages decide.

Learning reads labels of rows whose crc32(doc_id) mod 5 is not 0, at most
about ``MAX_FIT`` of them (by id hash), in numpy on the driver, with every passage
of their texts; the network has a few thousand numbers. Scoring covers every passage of every whole text.

Cases: null or empty text is one passage without words; without labels of both
kinds every score is the share of good labels (0.5 without any); a doc_id
labelled both ways counts as good; repeated rows each keep their row; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, span_hashes, stored, texts_of, word_spans
from .toxicity import bounded_sample

PASSAGE, MAX_FIT = 64, 16_000
HIDDEN, GATE, EPOCHS, RATE, BATCH = 24, 12, 12, 3e-3, 256
#: A training step takes at most BATCH documents, and no more of them once they have this many passages.
STEP_PASSAGES = 64 * BATCH

CLASSES = np.zeros((256, 8), bool)
CLASSES[[ord(x) for x in "#*$%&|<>"], 0] = True
CLASSES[65:91, 1] = True
CLASSES[97:123, 2] = True
CLASSES[48:58, 3] = True
CLASSES[[ord(x) for x in ".,;:!?"], 4] = True
CLASSES[[ord(x) for x in "!?"], 5] = True
CLASSES[128:, 6] = True
CLASSES[10, 7] = True
N_FEATURES = 18


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of statistics per passage, first passage of each text)."""
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    at = np.concatenate([[0], np.cumsum(n_pass)])
    total = int(at[-1])
    doc = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(len(starts)) - first[doc]
    of = at[doc] + place // PASSAGE
    count = np.bincount(of, minlength=total).astype(float)
    some = np.maximum(count, 1)
    length = (ends - starts).astype(float)
    x = np.zeros((total, N_FEATURES))
    # bytes of a passage: from its first word to the next passage's (the text's end)
    begin = np.repeat(offsets[:-1], n_pass).copy()
    heads = np.flatnonzero((place % PASSAGE == 0) & (place > 0))
    begin[of[heads]] = starts[heads]
    stop = np.append(begin[1:], len(data))
    size = np.maximum(stop - begin, 1)
    for k in range(8):
        run = np.concatenate([[0], np.cumsum(CLASSES[data, k])])
        x[:, k] = (run[stop] - run[begin]) / size
    x[:, 8] = np.log1p(count)
    mean = np.bincount(of, length, total) / some
    x[:, 9] = mean / 8
    x[:, 10] = np.sqrt(np.maximum(np.bincount(of, length**2, total) / some - mean**2, 0)) / 8
    words = span_hashes(data, starts, ends)
    last = np.lexsort((words, of))
    new = np.ones(len(words), bool)
    if len(words) > 1:
        same = (words[last][1:] == words[last][:-1]) & (of[last][1:] == of[last][:-1])
        new[1:] = ~same
    x[:, 11] = np.bincount(of[last][new], minlength=total) / some
    follow = np.zeros(len(words))
    if len(words) > 1:
        follow[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    x[:, 12] = np.bincount(of, follow, total) / some
    # words in pairs that stood in the text before, however far back
    if len(words) > 2:
        pair = mix64(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])
        inside = doc[:-1] == doc[1:]
        key = mix64(pair + doc[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key))
        again[order[1:]] = key[order][1:] == key[order][:-1]
        x[:, 13] = np.bincount(of[:-1], again * inside, total) / some
    upper = np.concatenate([[0], np.cumsum(CLASSES[data, 1])])
    lower = np.concatenate([[0], np.cumsum(CLASSES[data, 2])])
    shout = (upper[ends] - upper[starts] >= 2) & (lower[ends] == lower[starts])
    x[:, 14] = np.bincount(of, shout, total) / some
    tail = CLASSES[data[ends - 1], 0] if len(ends) else np.zeros(0)
    x[:, 15] = np.bincount(of, tail, total) / some
    x[:, 16] = np.repeat(np.log1p(n_words) / 8, n_pass)
    x[:, 17] = np.bincount(of, length > 20, total) / some
    return x, at


def _forward(w: dict[str, np.ndarray], x: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of bags; ``at`` holds the first passage of each bag."""
    h = np.tanh((x - w["mean"]) / w["spread"] @ w["W"] + w["b"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (t * g) @ w["a"]
    top = np.maximum.reduceat(e, at[:-1])
    sizes = np.diff(at)
    a = np.exp(e - np.repeat(top, sizes))
    a /= np.repeat(np.add.reduceat(a, at[:-1]), sizes)
    z = np.add.reduceat(a[:, None] * h, at[:-1], axis=0)
    s = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": s}


def _gradient(w: dict[str, np.ndarray], x: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, at)
    sizes = np.diff(at)
    ds = (f["s"] - y) / len(y)
    dz = np.repeat(ds[:, None] * w["c"], sizes, axis=0)
    da = (dz * f["h"]).sum(1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, at[:-1]), sizes))
    dt = de[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
    dg = de[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
    dh = f["a"][:, None] * dz + dt @ w["V"].T + dg @ w["U"].T
    du = dh * (1 - f["h"] ** 2)
    xs = (x - w["mean"]) / w["spread"]
    return {"W": xs.T @ du, "b": du.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ ds, "d": ds.sum()}


def _steps(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of at most BATCH bags and STEP_PASSAGES passages; a larger bag comes alone."""
    upto, lo = np.cumsum(sizes[order]), 0
    while lo < len(order):
        most = (upto[lo - 1] if lo else 0) + STEP_PASSAGES
        hi = min(lo + BATCH, max(lo + 1, int(np.searchsorted(upto, most, "right"))))
        yield order[lo:hi]
        lo = hi


def train(x: np.ndarray, at: np.ndarray, y: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on the mean log loss."""
    rng = np.random.Generator(np.random.PCG64(seed))
    n = x.shape[1]
    w = {
        "mean": x.mean(0), "spread": x.std(0) + 1e-3, "W": rng.normal(0, n**-0.5, (n, HIDDEN)), "b": np.zeros(HIDDEN),
        "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "a": rng.normal(0, GATE**-0.5, GATE),
        "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.array(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))),
    }
    m1 = {k: np.zeros_like(v) for k, v in w.items()}
    m2 = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(max(EPOCHS, -(-EPOCHS * 1000 // max(len(y), 1)))):
        order = rng.permutation(len(y))
        for bags in _steps(order, np.diff(at)):
            rows = np.concatenate([np.arange(at[b], at[b + 1]) for b in bags])
            own = np.concatenate([[0], np.cumsum(at[bags + 1] - at[bags])])
            step += 1
            for k, g in _gradient(w, x[rows], own, y[bags]).items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return w


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sampled document: its passages' statistics, flat, and its label."""
    for batch in batches:
        data, offsets = texts_of(batch)
        for lo, hi, part, off in chunks(data, offsets):
            x, at = features(part, off)
            flat = []
            for k in range(hi - lo):
                flat.append(x[at[k] : at[k + 1]].astype(np.float32).ravel())
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.list_(pa.float32())), batch.column(1).slice(lo, hi - lo)], ["x", "y"])


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, np.ndarray] | float:
    """The network, or the share of good labels where only one kind is labelled."""
    sample = bounded_sample(docs, labels, "quality", MAX_FIT).select("text", "y")
    got = sample.mapInArrow(_bags, "x array<float>, y int").toPandas()
    if got["y"].nunique() < 2:
        return float(got["y"].mean()) if len(got) else 0.5
    order = sorted(range(len(got)), key=lambda k: (got["y"][k], len(got["x"][k]), got["x"][k].tobytes() if hasattr(got["x"][k], "tobytes") else bytes()))
    bags = [np.asarray(got["x"][k], float).reshape(-1, N_FEATURES) for k in order]
    at = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return train(np.concatenate(bags), at, got["y"].to_numpy()[order].astype(float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score."""
    model = fit(docs, labels)
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("doc_id").schema.add("score", "double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch)
            out = np.zeros(len(offsets) - 1)
            for lo, hi, part, off in chunks(data, offsets):
                out[lo:hi] = _forward(sent.value, *features(part, off))["s"]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(rows, schema)

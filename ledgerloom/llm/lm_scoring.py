"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the ``REACH`` tokens on both sides: a hidden layer
sums one table row per neighbour and position, and a two-level softmax gives
the token's class and its place in the class. A document's score is the sum of
the conditional log-probabilities of all its tokens.

Counts of all words of all documents are kept as a table that grows with the
input. Its most frequent words are the network's vocabulary; every other word is
predicted as one of the hashed buckets, and its log-probability within the bucket
(its count over the counts of all the bucket's words) is added from the table: the
``HEAD`` most frequent of them are looked up in the tasks, the rest by a join on
the word's hash. The network is trained in
numpy inside the tasks, over all documents: each position is masked in exactly one
of ``ROUNDS`` rounds, by a hash of its document's id, place and word. In a round every
task runs Adagrad on the positions that are masked in it, and the tasks' networks
are averaged, weighted by the positions that they saw. The network's size is fixed; the word counts and what is averaged grow with
the input. A task's result depends only on its rows, so a retried task repeats it.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.

Cases: null or empty text has 0 tokens, log-probability 0 and null mean and
perplexity; an empty corpus leaves the starting network, which scores nothing;
repeated rows each keep their row; neighbours never cross documents; texts are
read whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD, chunks, mix64, span_hashes, stored, texts_of, with_fields, word_spans

CLASSES, MEMBERS, BUCKETS = 32, 32, 128
TOKENS = CLASSES * MEMBERS
REACH, HIDDEN = 2, 16
ROUNDS, BATCH, RATE = 2, 4096, 0.05
#: Shapes of the network's parts, in the order in which they are laid out flat.
SHAPES = (("T", (2 * REACH, TOKENS + 1, HIDDEN)), ("b", (HIDDEN,)), ("C", (CLASSES, HIDDEN)), ("c", (CLASSES,)), ("M", (CLASSES, MEMBERS, HIDDEN)), ("m", (CLASSES, MEMBERS)))
#: At most so many words outside the vocabulary are sent to the tasks with their log-probabilities; the others are joined.
HEAD = 1 << 17
#: Log-probabilities within buckets are summed as whole multiples of 1 / UNIT, so that the order of rows changes nothing.
UNIT = 1 << 32
#: Values in a piece of a network that is sent, and pieces averaged by one task.
PIECE, FAN = 4096, 32


def start_network(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    return {k: (rng.normal(0, 0.1, s) if k in "TCM" else np.zeros(s)).astype(np.float32) for k, s in SHAPES}


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k, _ in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES:
        n = int(np.prod(shape))
        out[k] = values[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(FOLD[data], starts, ends), first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch)
        for _, _, part, off in chunks(data, offsets):
            word, n = np.unique(_hashes(part, off)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of the corpus, by its hash."""
    counts = docs.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts, "words")


def vocabulary(counts: DataFrame) -> np.ndarray:
    """Hashes of the TOKENS - BUCKETS most frequent words, most frequent first."""
    top = counts.orderBy(F.desc("n"), "word").limit(TOKENS - BUCKETS).toPandas()
    return top["word"].to_numpy(np.int64).view(np.uint64)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes) % np.uint64(BUCKETS)).astype(np.int64)


class _Vocabulary:
    def __init__(self, words: np.ndarray):
        self.order = np.argsort(words)
        self.words = words[self.order]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Buckets first, then words by frequency."""
        bucket = bucket_of(hashes)
        if not len(self.words):
            return bucket
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, BUCKETS + self.order[at], bucket)


def within_buckets(counts: DataFrame, words: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """log p(word | its bucket) in 1 / UNIT of all words outside the vocabulary:
    a table (word, lp) of the rarer ones, and hashes, ascending, and values of the HEAD most frequent at most."""
    sent = counts.sparkSession.sparkContext.broadcast(words)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _Vocabulary(sent.value)
        for batch in batches:
            ids = vocab.ids(batch.column(0).to_numpy().view(np.uint64))
            other = ids < BUCKETS
            yield pa.RecordBatch.from_arrays([*(x.filter(pa.array(other)) for x in batch.columns), pa.array(ids[other].astype(np.int32))], ["word", "n", "bucket"])

    rest = counts.select("word", "n").mapInArrow(others, "word long, n long, bucket int").withColumn("size", F.floor(8 * F.log2("n")).cast("int"))
    # at most BUCKETS rows for each size of count, eight sizes to a doubling
    sizes = rest.groupBy("bucket", "size").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    totals = np.zeros(BUCKETS, np.int64)
    np.add.at(totals, sizes["bucket"], sizes["n"])
    per = sizes.groupby("size")["words"].sum().sort_index(ascending=False)
    fits = per[per.cumsum() <= HEAD]
    least = int(fits.index[-1]) if len(fits) else np.iinfo(np.int32).max
    total = F.element_at(F.array(*[F.lit(int(max(n, 1))) for n in totals]), F.col("bucket") + 1)
    lp = rest.select("word", "size", F.round(F.log(F.col("n") / total) * UNIT).cast("long").alias("lp"))
    head = lp.where(F.col("size") >= least).select("word", "lp").toPandas()
    hashes = head["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return lp.where(F.col("size") < least).select("word", "lp"), hashes[order], head["lp"].to_numpy(np.int64)[order]


def neighbours(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(2 * REACH, tokens): the tokens around each one; TOKENS stands outside a document."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(ids)) + REACH * (doc + 1)
    laid = np.full(len(ids) + REACH * len(first), TOKENS)
    laid[at] = ids
    return np.stack([laid[at + d] for d in (*range(-REACH, 0), *range(1, REACH + 1))]) if len(ids) else np.zeros((2 * REACH, 0), np.int64)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``_log_softmax`` of one entry of each row; ``x`` is overwritten."""
    x -= x.max(1, keepdims=True)
    own = x[np.arange(len(at)), at]
    return own - np.log(np.exp(x, out=x).sum(1))


def _hidden(net: dict[str, np.ndarray], around: np.ndarray) -> np.ndarray:
    z = np.repeat(net["b"][None], around.shape[1], axis=0)
    for j in range(2 * REACH):
        z += net["T"][j][around[j]]
    return np.tanh(z)


def _by_class(kind: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(kind.astype(np.int8), kind="stable")  # few bits are sorted by radix
    bounds = np.searchsorted(kind[order], np.arange(CLASSES + 1))
    for k in range(CLASSES):
        if bounds[k] < bounds[k + 1]:
            yield k, order[bounds[k] : bounds[k + 1]]


def log_probabilities(net: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """log p(token | both sides) of each token."""
    out = np.empty(len(ids), np.float64)
    for lo in range(0, len(ids), 1 << 15):
        own = ids[lo : lo + (1 << 15)]
        h = _hidden(net, around[:, lo : lo + (1 << 15)])
        kind, member = own // MEMBERS, own % MEMBERS
        part = _log_softmax_at(h @ net["C"].T + net["c"], kind).astype(np.float64)
        for k, rows in _by_class(kind):
            part[rows] += _log_softmax_at(h[rows] @ net["M"][k].T + net["m"][k], member[rows])
        out[lo : lo + (1 << 15)] = part
    return out


def gradient(net: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log-probability."""
    n = np.float32(len(ids))
    h = _hidden(net, around)
    kind, member = ids // MEMBERS, ids % MEMBERS
    g = {k: np.zeros_like(v) for k, v in net.items()}
    p = np.exp(_log_softmax(h @ net["C"].T + net["c"]))
    p[np.arange(len(ids)), kind] -= 1
    p /= n
    g["C"], g["c"] = p.T @ h, p.sum(0)
    dh = p @ net["C"]
    for k, rows in _by_class(kind):
        q = np.exp(_log_softmax(h[rows] @ net["M"][k].T + net["m"][k]))
        q[np.arange(len(rows)), member[rows]] -= 1
        q /= n
        g["M"][k], g["m"][k] = q.T @ h[rows], q.sum(0)
        dh[rows] += q @ net["M"][k]
    dz = dh * (1 - h * h)
    g["b"] = dz.sum(0)
    for j in range(2 * REACH):
        order = np.argsort(around[j].astype(np.int16), kind="stable")  # 16 bits are sorted by radix
        found = around[j][order]
        heads = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        g["T"][j][found[heads]] = np.add.reduceat(dz[order], heads, axis=0)
    return g


def round_of(hashes: np.ndarray, first: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The round in which each position is predicted; ``keys`` tell the documents apart."""
    own = np.diff(first)
    place = np.arange(len(hashes)) - np.repeat(first[:-1], own)
    return (mix64(mix64(np.repeat(keys, own) + place.astype(np.uint64)) + hashes) % np.uint64(ROUNDS)).astype(np.int64)


def _train(words, net, turn: int):
    """A task's network after Adagrad on the positions that this round masks, in pieces."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, own = _Vocabulary(words.value), unflat(net.value.copy())
        seen = {k: np.full_like(v, 1e-6) for k, v in own.items()}
        trained = 0
        for batch in batches:
            data, offsets = texts_of(batch)
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy().view(np.uint64)
            for lo, hi, part, off in chunks(data, offsets):
                hashes, first = _hashes(part, off)
                ids = vocab.ids(hashes)
                around = neighbours(ids, first)
                masked = np.flatnonzero(round_of(hashes, first, keys[lo:hi]) == turn)
                for at in range(0, len(masked), BATCH):
                    pick = masked[at : at + BATCH]
                    for k, g in gradient(own, ids[pick], around[:, pick]).items():
                        seen[k] += g * g
                        own[k] -= np.float32(RATE) * g / np.sqrt(seen[k])
                    trained += len(pick)
        if trained:
            values, task = flat(own), TaskContext.get().partitionId()
            pieces = [values[at : at + PIECE] for at in range(0, len(values), PIECE)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(pieces)), pa.int32()), pa.array([task] * len(pieces), pa.int32()),
                    pa.array(pieces, pa.list_(pa.float32())), pa.array([trained] * len(pieces), pa.int64()),
                ],
                ["piece", "task", "v", "n"],
            )

    return rows


def _mean(part: pa.Table) -> pa.Table:
    """The mean of up to FAN networks' pieces, weighted by the positions they saw."""
    part = part.sort_by("task")
    n = part["n"].to_numpy()
    v = np.stack(part["v"].to_pylist()).astype(np.float64)
    mean = (v * n[:, None]).sum(0) / n.sum()
    return pa.table(
        {"piece": part["piece"][:1], "task": pa.array([part["task"][0].as_py() // FAN], pa.int32()), "v": pa.array([mean.astype(np.float32)], pa.list_(pa.float32())), "n": pa.array([n.sum()], pa.int64())}
    )


def train(docs: DataFrame, words: np.ndarray) -> np.ndarray:
    """The flat network."""
    context = docs.sparkSession.sparkContext
    sent, net = context.broadcast(words), flat(start_network())
    texts = docs.select("text", F.xxhash64("doc_id").alias("key"))
    for turn in range(ROUNDS):
        schema = "piece int, task int, v array<float>, n long"
        parts = texts.mapInArrow(_train(sent, context.broadcast(net), turn), schema)
        tasks = texts.rdd.getNumPartitions()
        while True:  # FAN networks at a time, piece by piece, until one is left
            parts = parts.groupBy("piece", F.floor(F.col("task") / FAN).alias("next")).applyInArrow(_mean, schema)
            tasks = -(-tasks // FAN)
            if tasks <= 1:
                break
        mean = parts.collect()  # one network: a fixed number of values
        if mean:
            net = np.concatenate([np.array(r["v"], np.float32) for r in sorted(mean, key=lambda r: r["piece"])])
    return net


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log_prob, mean_log_prob, perplexity."""
    context = docs.sparkSession.sparkContext
    counts = word_counts(docs)
    top = vocabulary(counts)
    tail, *head = within_buckets(counts, top)
    words, net, known = (context.broadcast(x) for x in (top, train(docs, top), head))
    schema = with_fields(docs.select("doc_id"), "n_tokens long, log_prob double, inside long, others array<long>")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, own, (hash_of, lp_of) = _Vocabulary(words.value), unflat(net.value), known.value
        for batch in batches:
            data, offsets = texts_of(batch)
            count, total, inside = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            others, per = [], np.zeros(batch.num_rows + 1, np.int64)
            for lo, hi, part, off in chunks(data, offsets):
                hashes, first = _hashes(part, off)
                ids = vocab.ids(hashes)
                run = np.concatenate([[0.0], np.cumsum(log_probabilities(own, ids, neighbours(ids, first)))])
                count[lo:hi] = np.diff(first)
                total[lo:hi] = run[first[1:]] - run[first[:-1]]
                at = np.flatnonzero(ids < BUCKETS)  # words that only share a bucket: their probability inside it
                spot = np.searchsorted(hash_of, hashes[at])
                spot[spot == len(hash_of)] = 0
                found = hash_of[spot] == hashes[at] if len(hash_of) else np.zeros(len(at), bool)
                lp = np.zeros(len(ids) + 1, np.int64)
                lp[at[found] + 1] = lp_of[spot[found]]
                lp = np.cumsum(lp)
                inside[lo:hi] = lp[first[1:]] - lp[first[:-1]]
                others.append(hashes[at[~found]].view(np.int64))
                per[lo + 1 : hi + 1] = np.diff(np.searchsorted(at[~found], first))
            left = pa.ListArray.from_arrays(pa.array(np.cumsum(per), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *others])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(total), pa.array(inside), left], schema.names)

    scored = docs.select("doc_id", "text").mapInArrow(rows, schema).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "scored")
    # a word outside the vocabulary has under 1 / (TOKENS - BUCKETS) of all tokens, and one outside HEAD far less: no key is hot
    rare = scored.select("row", F.explode("others").alias("word")).join(tail, "word").groupBy("row").agg(F.sum("lp").alias("rare"))
    total = F.col("log_prob") + (F.col("inside") + F.coalesce("rare", F.lit(0))) / UNIT
    scored = scored.drop("others").join(rare, "row", "left").select("doc_id", "n_tokens", total.alias("log_prob"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-F.col("mean_log_prob")))

"""Benchmark decontamination: a BM25 index of test items, block-max pruned.

Every training document is cut into overlapping passages, each a query against
the inverted index of the test items. An item's impacts are BM25 weights
divided by its own full score, so a score is the matched share of the item and
one threshold serves all. Items stand in blocks; a passage's sum of its terms'
block maxima bounds the scores in the block, and only blocks whose bound
reaches the threshold are scored. Everything at or above it is retrieved, then
verified: the share of the item's ``NGRAM``-word shingles that the passage holds,
over the whole item, its question (all sentences but the last) and its answer
(the last sentence; the last third where there is only one).

A leak holds ``OVERLAP`` of the item's shingles, or of its question's and its
answer's. Document frequencies, the number of items, their mean length and the
passages' width are taken once over the whole benchmark. Items are dealt by hash to
parts of about ``PART`` items or ``PART_WORDS`` words; each part's index is built in a
task, and one scan of the documents meets ``PARTS`` of them, so what is sent doesn't
grow with the benchmark and scores don't depend on the parts.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased.

Cases: null or empty texts and items match nothing; an item with fewer than
NGRAM words has its whole sequence as one shingle; repeated items are items of
their own; rows with one doc_id give one row per item, the best; ties in score
keep the first passage; an empty benchmark or table gives no rows; other columns are
ignored; texts are read whole.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD, chunks, span_hashes, stored, texts_of, windows_of, with_fields, word_spans
from .toxicity import LETTERS

K1, B = 1.2, 0.75
NGRAM, OVERLAP, THRESHOLD = 5, 0.8, 0.5
BLOCK = 8
#: Items and words of an index at most (about: items are dealt by hash), and indexes sent at once.
PART, PART_WORDS, PARTS = 512, 1 << 16, 16
#: Numbers of block bounds or postings summed at once.
AT_ONCE = 1 << 22
#: Passages advance by at least this many words, or by 1.25 times the longest item; they are twice as long.
MIN_STEP = 32


class Stats(NamedTuple):
    """Of all items with words, whatever parts they are dealt to."""

    items: int
    mean_words: float
    longest: int


def _words(text: str) -> np.ndarray:
    data = FOLD[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), LETTERS)
    return span_hashes(data, starts, ends)


def _shingles(words: np.ndarray) -> tuple[int, np.ndarray]:
    """(length, shingles): a part below NGRAM words is one shingle of its own length."""
    n = min(NGRAM, len(words))
    return n, np.unique(windows_of(words, n)) if n else np.zeros(0, np.uint64)


def question_and_answer(text: str) -> tuple[str, str]:
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"[^\W_]", p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - len(words) // 3
    return " ".join(words[:cut]), " ".join(words[cut:])


def build_index(items: list[tuple], stats: Stats, df: np.ndarray, terms: np.ndarray) -> dict:
    """Index of (item_id, text), all with words: sorted vocabulary, block maxima by term,
    impacts by (term, item), shingles. ``df`` holds the document frequency of each of the
    sorted hashes ``terms``, counted like ``stats`` over the whole benchmark."""
    ids = [item for item, _ in items]
    words = [_words(text) for _, text in items]
    n = len(ids)
    lengths = np.array([len(w) for w in words], float)
    vocab, term = np.unique(np.concatenate(words), return_inverse=True)
    of = np.repeat(np.arange(n), lengths.astype(int))
    key, tf = np.unique(term * n + of, return_counts=True)
    t, i = key // n, key % n
    seen = df[np.searchsorted(terms, vocab)]
    idf = np.log1p((stats.items - seen + 0.5) / (seen + 0.5))
    weight = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[i] / stats.mean_words))
    impact = weight / np.bincount(i, weight, n)[i]
    blocks = -(-n // BLOCK)
    most = np.zeros((len(vocab), blocks), np.float32)
    np.maximum.at(most, (t, i // BLOCK), impact.astype(np.float32))
    # the first posting of each term in each block, and one more at the end
    cells = np.bincount(t * blocks + i // BLOCK, minlength=len(vocab) * blocks)
    parts = [question_and_answer(text) for _, text in items]
    return {
        "ids": ids, "vocab": vocab, "most": most, "first": np.concatenate([[0], np.cumsum(cells)]).astype(np.int32),
        "place": (i % BLOCK).astype(np.int8), "impact": impact, "step": max(MIN_STEP, int(1.25 * stats.longest)),
        "whole": [_shingles(w) for w in words], "question": [_shingles(_words(q)) for q, _ in parts], "answer": [_shingles(_words(a)) for _, a in parts],
    }


def _passage_terms(index: dict, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term) pairs, distinct and ordered; each passage's first and last word."""
    step, vocab = index["step"], index["vocab"]
    n = np.diff(first)
    count = np.maximum(1, -(-n // step) - 1)
    base = np.concatenate([[0], np.cumsum(count)])
    inside = np.arange(base[-1]) - np.repeat(base[:-1], count)
    start = np.repeat(first[:-1], count) + inside * step
    stop = np.minimum(start + 2 * step, np.repeat(first[1:], count))
    at = np.searchsorted(vocab, words)
    at[at == len(vocab)] = 0
    known = np.flatnonzero(vocab[at] == words)
    doc = np.searchsorted(first, known, "right") - 1
    part = (known - first[doc]) // step
    one = np.minimum(part, count[doc] - 1)
    two = part - 1
    second = (two >= 0) & (two != one)
    pairs = np.concatenate([(base[doc] + one) * len(vocab) + at[known], ((base[doc] + two) * len(vocab) + at[known])[second]])
    pairs = np.unique(pairs)
    return pairs // len(vocab), pairs % len(vocab), start, stop


def retrieve(index: dict, passage: np.ndarray, term: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float]]:
    """(passage, item, score) of all scores at or above the threshold."""
    if not len(passage):
        return
    heads = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    ends = np.append(heads[1:], len(passage))
    able = np.flatnonzero(np.add.reduceat(index["most"].max(1)[term], heads) >= threshold - 1e-4)
    width = index["most"].shape[1]
    run = max(1, AT_ONCE // (width * max(int((ends - heads).mean()), 1)))
    for lo in range(0, len(able), run):
        some = able[lo : lo + run]
        sizes = ends[some] - heads[some]
        cut = np.cumsum(sizes) - sizes
        rows = np.repeat(heads[some] - cut, sizes) + np.arange(sizes.sum())
        bound = np.add.reduceat(index["most"][term[rows]], cut, axis=0)
        k, block = np.nonzero(bound >= threshold - 1e-4)
        step = max(1, AT_ONCE // (4 * max(int(sizes.max()), 1)))
        for s in range(0, len(k), step):
            own, b = some[k[s : s + step]], block[s : s + step]
            for at, place, score in _block_scores(index, term, heads[own], ends[own] - heads[own], b, threshold):
                yield int(passage[heads[own[at]]]), int(b[at]) * BLOCK + place, score


def _block_scores(index: dict, term: np.ndarray, head: np.ndarray, sizes: np.ndarray, block: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float]]:
    """(pair, place in its block, score) at or above the threshold, for pairs of a passage
    (``sizes`` terms from ``head`` on) and a block: the postings of all pairs summed at once."""
    cut = np.cumsum(sizes) - sizes
    pair = np.repeat(np.arange(len(sizes)), sizes)
    cell = term[np.repeat(head - cut, sizes) + np.arange(len(pair))] * index["most"].shape[1] + block[pair]
    lo = index["first"][cell]
    count = index["first"][cell + 1] - lo
    held = np.flatnonzero(count)
    lo, count, pair = lo[held], count[held], pair[held]
    posting = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
    score = np.bincount(np.repeat(pair, count) * BLOCK + index["place"][posting], index["impact"][posting], len(sizes) * BLOCK)
    for x in np.flatnonzero(score >= threshold):
        yield int(x // BLOCK), int(x % BLOCK), float(score[x])


def _share(part: tuple[int, np.ndarray], words: np.ndarray) -> float:
    n, shingles = part
    return float(np.isin(shingles, windows_of(words, n)).mean()) if n else 0.0


def _find(ix: dict, batch: pa.RecordBatch, threshold: float, overlap: float) -> list[tuple]:
    """(row, item_id, score, overlaps of the whole, question and answer, first word) of verified passages."""
    data, offsets = texts_of(batch)
    found = []
    for lo, _, part, off in chunks(data, offsets):
        part = FOLD[part]
        starts, ends, first = word_spans(part, off, LETTERS)
        words = span_hashes(part, starts, ends)
        passage, term, start, stop = _passage_terms(ix, words, first)
        for p, item, score in retrieve(ix, passage, term, threshold):
            own = words[start[p] : stop[p]]
            whole, question, answer = (_share(ix[x][item], own) for x in ("whole", "question", "answer"))
            if whole >= overlap or (question >= overlap and answer >= overlap):
                row = int(np.searchsorted(first, start[p], "right")) - 1
                found.append((lo + row, ix["ids"][item], score, whole, question, answer, int(start[p] - first[row])))
    return found


def _scan(indexes: list, threshold: float, overlap: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for index in indexes for x in _find(index.value, batch, threshold, overlap)]
            row, *cols = zip(*found) if found else ((),) * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[1:5]], pa.array(cols[5], pa.int64())],
                ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap", "first_word"],
            )

    return rows


def _without(indexes: list, threshold: float, overlap: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for index in indexes:
                keep[[f[0] for f in _find(index.value, batch, threshold, overlap)]] = False
            yield batch.filter(pa.array(keep))

    return rows


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, number of its words, distinct word hashes) of items with words."""
    for batch in batches:
        row, n, terms = [], [], []
        for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = _words(text)
            if len(w):
                row.append(at)
                n.append(len(w))
                terms.append(np.unique(w).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int64()))], ["row", "n", "terms"])


def _build(stats: Stats):
    def part(items: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        counts = counts.drop_duplicates("h")
        terms = counts["h"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(terms)
        items = items.sort_values("row")
        index = build_index(list(zip(items["item_id"], items["text"])), stats, counts["df"].to_numpy()[order], terms[order])
        return pd.DataFrame({"built": [pickle.dumps(index)]})

    return part


def _indexes(benchmark: DataFrame, part: int) -> Iterator[list]:
    """Broadcast indexes of about ``part`` items each (fewer where items are long),
    PARTS of them at once, built in tasks from statistics over the whole benchmark."""
    spark = benchmark.sparkSession
    items = stored(benchmark.select("item_id", "text").where("text is not null").withColumn("row", F.monotonically_increasing_id()), "items")
    terms = stored(items.select("row", "text").mapInArrow(_postings, "row long, n long, terms array<long>"), "postings")
    total = terms.agg(F.count("*").alias("items"), F.sum("n").alias("words"), F.max("n").alias("longest")).first()
    if not total["items"]:
        return
    stats = Stats(total["items"], total["words"] / total["items"], total["longest"])
    parts = max(-(-total["items"] // part), -(-total["words"] // PART_WORDS))
    dealt = terms.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    words = dealt.select("part", F.explode("terms").alias("h"))
    # each word once a part, with its document frequency over all items
    df = words.groupBy("h").agg(F.count("*").alias("df"), F.collect_set("part").alias("in"))
    counts = df.select(F.explode("in").alias("part"), "h", "df")
    texts = items.join(dealt.select("row", "part"), "row")
    built = texts.groupBy("part").cogroup(counts.groupBy("part")).applyInPandas(_build(stats), "built binary")
    held = []
    for row in stored(built, "indexes").toLocalIterator():
        held.append(spark.sparkContext.broadcast(pickle.loads(row["built"])))
        if len(held) == PARTS:
            yield held
            held = []
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, part: int = PART) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap, first_word of the best passage."""
    spark = docs.sparkSession
    schema = with_fields(docs.select("doc_id"), "item_id long, score double, overlap double, question_overlap double, answer_overlap double, first_word long")
    found = spark.createDataFrame([], schema)
    for indexes in _indexes(benchmark, part):
        found = found.union(docs.select("doc_id", "text").mapInArrow(_scan(indexes, threshold, overlap), schema))
    best = F.max_by(F.struct("overlap", "question_overlap", "answer_overlap", "first_word"), F.struct("overlap", "score", -F.col("first_word")))
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best.alias("best")).select("doc_id", "item_id", F.round("score", 6).alias("score"), "best.*")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, part: int = PART) -> DataFrame:
    """The rows of ``docs`` that leak no item, as they are; judged row by row."""
    for indexes in _indexes(benchmark, part):
        docs = docs.mapInArrow(_without(indexes, threshold, overlap), docs.schema)
    return docs

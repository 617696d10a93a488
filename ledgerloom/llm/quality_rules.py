"""Quality rules and a hashed n-gram log-likelihood ratio.

Words and word pairs of every document are hashed into ``BINS`` bins. Two
multinomials are counted: the trusted target (documents labelled of good
quality, outside the held-out fold, all of them) and the raw corpus
(all documents). A
document's ratio is the mean over its n-grams of log(target / raw); a trusted
document's own n-grams are taken out of the target first, so that no verdict
depends on whether a label was read. A document is kept if no base rule fails and its ratio is at least the threshold: the
mean less ``SPREADS`` standard deviations of all trusted documents that pass the
base rules (it is held against such documents only), a fixed number.

Base rules: fewer than 50 words, or more than half of the words in 3-word
windows that stand in the text twice or more.

Cases: null or empty text has no words and fails the base rules; a document of
words unknown to the target has the ratio of its bins' smoothed counts;
without trusted documents the ratio is 0 for all and only base rules decide;
repeated rows each keep their row; an empty table gives no rows; extra columns
are ignored. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, FOLD, chunks, filter_bit, hash_filter, in_filter, mix64, span_hashes, stored, texts_of, word_spans
from .toxicity import fold_of

BINS = 1 << 16
#: Added to each bin of both multinomials, times the raw corpus's share of the bin for the target.
PRIOR = 0.5
SPREADS = 6.0
#: The filter of trusted ids grows to so many bits (32 MB); with more ids it lets more texts through to the join.
MOST_FILTER_BITS = 1 << 28
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(x) for x in "#*$%&|<>"]] = True


def gram_bins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all words and pairs, and the row of each."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(FOLD[data], starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pairs = mix64(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])
    inside = row[:-1] == row[1:]
    shift = np.uint64(64 - 16)
    return np.concatenate([words >> shift, pairs[inside] >> shift]).astype(np.int64), np.concatenate([row, row[:-1][inside]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bin counts of a task's texts."""
    sums = np.zeros(BINS, np.int64)
    for batch in batches:
        data, offsets = texts_of(batch)
        for _, _, part, off in chunks(data, offsets):
            sums += np.bincount(gram_bins(part, off)[0], minlength=BINS)
    full = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(sums[full])], ["bin", "n"])


def bin_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences by bin over all rows of ``texts``."""
    found = texts.select("text").mapInArrow(_counts, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BINS)
    out[found["bin"]] = found["n"]
    return out


def log_ratio(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """log(target / raw) by bin; the target is smoothed towards the raw corpus."""
    if not trusted.sum():
        return np.zeros(BINS)
    p = (raw + PRIOR) / (raw.sum() + PRIOR * BINS)
    q = (trusted + PRIOR * BINS * p) / (trusted.sum() + PRIOR * BINS)
    return np.log(q / p)


def target_of(raw: np.ndarray, trusted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What documents are held against: log ratio, raw share and trusted count by bin."""
    return log_ratio(raw, trusted), (raw + PRIOR) / (raw.sum() + PRIOR * BINS), trusted


def ratios(target: tuple, data: np.ndarray, offsets: np.ndarray, counted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each row's mean log ratio; the same against the target without the row's own n-grams, for rows ``counted`` marks."""
    llr, p, trusted = target
    total, rows = trusted.sum(), len(offsets) - 1
    counted = np.zeros(rows, bool) if counted is None else counted
    out, without = np.zeros(rows), np.zeros(rows)
    for lo, hi, part, off in chunks(data, offsets):
        bins, row = gram_bins(part, off)
        n = np.bincount(row, minlength=hi - lo)
        value = llr[bins]
        out[lo:hi] = np.bincount(row, value, hi - lo) / np.maximum(n, 1)
        mine = np.flatnonzero(counted[lo:hi][row])
        if len(mine):
            cell, at, times = np.unique(row[mine] * BINS + bins[mine], return_inverse=True, return_counts=True)
            b = cell % BINS
            # a row that only seems counted may hold more than the target does
            rest = np.maximum(trusted[b] - times, 0) + PRIOR * BINS * p[b]
            size = np.maximum(total - n[cell // BINS], 0) + PRIOR * BINS
            value[mine] = np.log(rest / size / p[b])[at]
        without[lo:hi] = np.bincount(row, value, hi - lo) / np.maximum(n, 1)
    return out, without


def base_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per row."""
    out = np.zeros((len(offsets) - 1, 5), np.int64)
    for lo, hi, part, off in chunks(data, offsets):
        rows = hi - lo
        starts, ends, first = word_spans(part, off)
        words = span_hashes(part, starts, ends)
        # a code point is a byte that doesn't continue one
        heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        chars = np.concatenate([[0], np.cumsum(heads[ends] - heads[starts])])
        symbols = np.concatenate([[0], np.cumsum(SYMBOLS[part])])
        out[lo:hi, 0] = np.diff(first)
        out[lo:hi, 1] = np.diff(chars[first])
        out[lo:hi, 2] = np.diff(symbols[off])
        for k in range(rows):
            own = words[first[k] : first[k + 1]]
            if len(own) >= 3:
                tri = mix64(mix64(own[:-2] * np.uint64(0xD6E8FEB86659FD93) + own[1:-1]) * np.uint64(0xD6E8FEB86659FD93) + own[2:])
                order = np.argsort(tri, kind="stable")
                same = tri[order][1:] == tri[order][:-1]
                again = np.zeros(len(tri), bool)
                again[order[1:][same]] = again[order[:-1][same]] = True
                cover = np.zeros(len(own), bool)
                cover[:-2] |= again
                cover[1:-1] |= again
                cover[2:] |= again
                out[lo + k, 4] = cover.sum()
            text = part[off[k] : off[k + 1]].tobytes()
            if b"\n" in text:
                lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
                out[lo + k, 3] = len(lines) - len(set(lines))
    return out


def failing(counts: np.ndarray) -> np.ndarray:
    """Rows of :func:`base_counts` that a base rule fails."""
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def trusted_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_ids labelled of good quality outside the held-out fold, each once, written."""
    good = labels.where((F.col("quality") == 1) & (fold_of(F.col("doc_id")) != 0))
    good = good.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")).where(F.col("doc_id").isNotNull())
    return stored(good.distinct(), "good")


def filter_of(good: DataFrame) -> tuple[np.ndarray, int]:
    """A hash filter of the trusted ids and its bits: about eight an id, within bounds."""
    bits = min(max(FILTER_BITS, 1 << (8 * good.count()).bit_length()), MOST_FILTER_BITS)
    return hash_filter(good, "doc_id", bits), bits


def fit(docs: DataFrame, good: DataFrame, bitmap: np.ndarray, bits: int) -> tuple[tuple, float]:
    """(target, threshold); raw counts cover all documents, the target all trusted ones, the threshold those that pass the base rules.

    Trusted texts are marked once: what the filter lets through meets the ids
    in a semi join and is written. Each is measured against the target without it."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(bitmap)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(batch.schema.get_field_index("bit")).to_numpy()
            yield batch.filter(pa.array(in_filter(sent.value, bit)))

    keyed = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", filter_bit(F.col("doc_id"), bits).alias("bit"))
    trusted = keyed.mapInArrow(passing, keyed.schema).join(good, "doc_id", "left_semi").select("text")
    trusted = stored(trusted, "trusted")
    target = target_of(bin_counts(docs), bin_counts(trusted))
    model = context.broadcast(target)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = texts_of(batch)
            passed = ~failing(base_counts(*text))
            own = ratios(model.value, *text, np.ones(batch.num_rows, bool))[1]
            yield pa.RecordBatch.from_arrays([pa.array(own[passed])], ["r"])

    n, mean, spread = trusted.mapInArrow(measured, "r double").agg(F.count("r"), F.avg("r"), F.stddev_pop("r")).first()  # three numbers
    return target, float(mean - SPREADS * spread) if n else float("-inf")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the ratio."""
    good = trusted_ids(docs, labels)
    bitmap, bits = filter_of(good)
    target, threshold = fit(docs, good, bitmap, bits)
    sent = docs.sparkSession.sparkContext.broadcast((target, bitmap))
    schema = docs.select("doc_id").schema
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        schema = schema.add(name, "long")
    schema = schema.add("ratio", "double").add("without", "double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = sent.value
        for batch in batches:
            text = texts_of(batch)
            counts = base_counts(*text)
            both = ratios(model, *text, in_filter(known, batch.column(2).to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[:, k]) for k in range(5)], *[pa.array(r) for r in both]], schema.names
            )

    judged = docs.select("doc_id", "text", filter_bit(F.col("doc_id"), bits).alias("bit")).mapInArrow(rows, schema)
    # a trusted document is held against the target without it, as any other is
    judged = judged.join(good.withColumn("trusted", F.lit(True)), "doc_id", "left")
    judged = judged.withColumn("ratio", F.when(F.col("trusted"), F.col("without")).otherwise(F.col("ratio")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )

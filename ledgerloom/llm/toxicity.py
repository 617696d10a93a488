"""Toxicity by class-conditional Kneser-Ney models.

A bigram model with absolute discounting is estimated for toxic and for
ordinary labelled documents. Every order counts the distinct contexts to the
left of an expression, so copies of one text count once. Both classes share their backoff: what rare or unseen expressions fall back to is the continuation distribution
(distinct left neighbours) over both classes, with one backoff mass for both,
so an expression that neither class knows says nothing. A document's evidence
is its length-normalised log-likelihood ratio, over the whole text and over
its most toxic windows of ``WINDOWS`` words; a logistic link fitted on labelled
documents that the counts have not seen gives the score.

Learning reads all labels of rows whose crc32(doc_id) mod 5 is not 0:
remainders 1 to 3 give the counts, 4 the link, whose Newton steps are sums over
all of all of their rows. Expressions with fewer than ``MIN_COUNT`` contexts count in
all sums and are left to the backoff, as ratios of so few say more of the texts
that were read than of a class. All others are kept: up to ``MAX_ENTRIES`` words
and bigrams, those with most contexts, are sent to the executors, the rest is a
table that is joined. A bigram whose left word only one class has is left to its
word. Scoring covers every whole text.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased.

Cases: null and empty texts have no evidence and get the score of an
evidence-free text; a document without usable labels is still scored; without
labels of both classes every score is 0; conflicting labels of one doc_id
count as toxic; repeated rows each keep their row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c
from .ngram_join import _gram_filter

#: Contexts of a kept expression at least; words, and bigrams, that are sent at most: those beyond are joined.
MIN_COUNT, MAX_ENTRIES = 6, 200_000
#: Bytes of labelled text whose trigrams are made distinct before they are shuffled.
TYPES_BYTES = 8 * c.CHUNK_BYTES
#: Besides the whole text, the ratio is taken over its most toxic window of each of these numbers of words.
WINDOWS = (1, 8)
#: Backoff mass of both classes at the unigram and at the bigram level.
MASS = 0.1
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, y, fold of the labelled ids outside fold 0, written."""
    known = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    return c.stored(known.select("doc_id", "y", fold_of(F.col("doc_id")).alias("fold")).where("fold <> 0"), "labels")


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """text, y of all rows with a known label. Rows without one are left out before the join."""
    sent = docs.sparkSession.sparkContext.broadcast(c.hash_filter(known, "doc_id"))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.filter(pa.array(c.in_filter(sent.value, batch.column(2).to_numpy())))
            yield found.select(["doc_id", "text"])

    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", c.filter_bit(F.col("doc_id")).alias("bit"))
    rows = rows.mapInArrow(maybe, docs.select("doc_id", "text").schema)
    return known.join(rows, "doc_id").select("text", "y")


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """text, y, fold of labelled rows outside fold 0, about ``limit`` at most, chosen by id hash."""
    known = known_labels(labels, label)
    n = known.count()
    share = min(1.0, limit / n) if n else 1.0
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return known.join(docs.select("doc_id", "text"), "doc_id").select("text", "y", "fold")


def gram_of(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    return c.mix64(left * np.uint64(0xD6E8FEB86659FD93) + word)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, the words before them (0 at a row's start), hashes of both, and each row's first word."""
    data = c.FOLD[data]
    starts, ends, first = c.word_spans(data, offsets, LETTERS)
    words = c.span_hashes(data, starts, ends)
    before = np.zeros(len(words), np.uint64)
    before[1:] = words[:-1]
    heads = first[:-1]
    before[heads[heads < len(words)]] = 0
    return words, before, gram_of(before, words), first


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to ``limit`` bytes; a larger one comes alone."""
    waiting, size = [], 0
    for batch in batches:
        if waiting and size + batch.nbytes > limit:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
        waiting.append(batch)
        size += batch.nbytes
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def _types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct trigrams of about ``TYPES_BYTES`` of text, as (before, left, word), and the classes that have them:
    1 ordinary, 2 toxic, 3 both. Those of a bigram stand together, which makes them small when they are shuffled."""
    for batch in _gathered(batches, TYPES_BYTES):
        y = batch.column(1).to_numpy(zero_copy_only=False)
        data, offsets = c.texts_of(batch)
        for lo, hi, part, off in c.chunks(data, offsets, TYPES_BYTES):
            words, left, pairs, first = _grams(part, off)
            if not len(words):
                continue
            toxic = np.repeat(y[lo:hi], np.diff(first)).astype(bool)
            before = np.zeros(len(words), np.uint64)
            before[1:] = left[:-1]
            heads = first[:-1]
            before[heads[heads < len(words)]] = 0
            context = c.mix64(before * np.uint64(0xC2B2AE3D27D4EB4F) + pairs)
            _, at, of = np.unique(context, return_index=True, return_inverse=True)
            order = np.lexsort((words[at], left[at]))
            kinds = (np.bincount(of, ~toxic, len(at)) > 0) + 2 * (np.bincount(of, toxic, len(at)) > 0)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[at][order].view(np.int64)) for x in (before, left, words)), pa.array(kinds[order].astype(np.int8))], ["before", "left", "word", "kinds"]
            )


def _class_probabilities(t: np.ndarray, n: np.ndarray, totals: tuple, types: tuple, backoff_t, backoff_n):
    """Discounted counts of both classes over one shared backoff mass."""
    out = []
    for count, total, kinds, back in ((t, totals[0], types[0], backoff_t), (n, totals[1], types[1], backoff_n)):
        d = np.minimum(1.0, MASS * total / np.maximum(kinds, 1))
        out.append(np.maximum(count - d, 0.0) / np.maximum(total, 1) + MASS * back)
    return out


def rare_key(words: np.ndarray) -> np.ndarray:
    """Words' keys among those of bigrams."""
    return c.mix64(words ^ np.uint64(0xA0761D6478BD642F))


def _word_ratios(totals: list):
    """word, key, count and the ratio of words with t, n, lefts; ``totals``: sums of t, n, lefts, kt, kn, k over all words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, t, n, lefts = (batch.column(k).to_numpy() for k in range(4))
            wt, wn = _word_probabilities(t, n, lefts, totals)
            key = rare_key(word.view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (word, key, t + n, np.log(wt / wn))], ["entry", "key", "count", "llr"])

    return rows


def _word_probabilities(t: np.ndarray, n: np.ndarray, lefts: np.ndarray, totals: list):
    shared = (lefts + 0.5) / (totals[2] + 0.5 * totals[5])
    return _class_probabilities(t, n, totals[:2], totals[3:5], shared, shared)


def _pair_ratios(totals: list):
    """The same of bigrams, from their counts, the left word's and the word's own."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, word, t, n, lt, ln, kt, kn, *own = (batch.column(k).to_numpy() for k in range(11))
            pt, pn = _class_probabilities(t, n, (lt, ln), (kt, kn), *_word_probabilities(*own, totals))
            gram = gram_of(left.view(np.uint64), word.view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, gram, t + n, np.log(pt / pn))], ["entry", "key", "count", "llr"])

    return rows


def _split(ratios: DataFrame, limit: int) -> tuple[pa.Table, DataFrame | None]:
    """entry, llr of those with most contexts, sorted, ``limit`` at most, and key, llr of all others, None if there are none."""
    sizes = sorted(((r["count"], r["n"]) for r in ratios.groupBy("count").agg(F.count("*").alias("n")).collect()), reverse=True)
    least, n = (sizes[0][0] + 1 if sizes else 0), 0
    for count, own in sizes:
        if n + own > limit:
            break
        least, n = count, n + own
    head = ratios.where(F.col("count") >= least).select("entry", "llr").toArrow().sort_by("entry")
    return head, None if n == sum(own for _, own in sizes) else ratios.where(F.col("count") < least).select("key", "llr")


def fit_models(sample: DataFrame) -> dict | None:
    """Sorted word and bigram hashes with their log-likelihood ratios, from text and y; ``sample`` is read once.
    ``rare`` is a table (key, llr) of what is too many to be sent, or None."""
    types = sample.mapInArrow(_types, "before long, left long, word long, kinds byte")
    # a bigram's trigrams, each once a chunk of text, meet in one task: they are shuffled once, and their counts not at all
    types = types.repartition("left", "word").groupBy("before", "left", "word").agg(F.expr("bit_or(kinds)").alias("kinds"))
    toxic, ordinary = (F.col("kinds") >= 2).cast("long"), (F.col("kinds") % 2).cast("long")
    pairs = types.groupBy("left", "word").agg(F.sum(toxic).alias("t"), F.sum(ordinary).alias("n"))
    pairs = c.stored(pairs.sortWithinPartitions("left"), "bigrams")  # sorted, they take less disk
    often = c.stored(pairs.where(F.col("t") + F.col("n") >= MIN_COUNT), "often")
    few = often.count() <= MAX_ENTRIES
    # few bigrams are broadcast: a very common left word is then no hot key, and what they don't need isn't shuffled
    sent = F.broadcast if few else lambda rows: rows
    has = lambda x: F.sum((F.col(x) > 0).cast("long"))
    words = pairs.groupBy("word").agg(has("t").alias("t"), has("n").alias("n"), F.count("*").alias("lefts"))
    words = c.stored(words, "all_words")
    # those that are kept, and the sums of all others in a row without a word
    kept = F.when(F.col("t") + F.col("n") >= MIN_COUNT, F.col("word")).alias("word")
    sums = [F.sum(x).alias(x) for x in ("t", "n", "lefts")]
    whole = c.stored(words.groupBy(kept).agg(*sums, has("t").alias("kt"), has("n").alias("kn"), F.count("*").alias("k")), "words")
    total = whole.agg(*[F.sum(x) for x in ("t", "n", "lefts", "kt", "kn", "k")]).first()
    if not total[0] or not total[1]:
        return None
    total = list(total)
    kind = "entry long, key long, count long, llr double"
    w = whole.where("word is not null").select("word", "t", "n", "lefts").mapInArrow(_word_ratios(total), kind)
    sums = [F.sum("t").alias("lt"), F.sum("n").alias("ln"), has("t").alias("kt"), has("n").alias("kn")]
    if few:
        lefts = pairs.join(F.broadcast(often.select("left").distinct()), "left", "left_semi").groupBy("left").agg(*sums)
    else:
        lefts = c.stored(pairs.groupBy("left").agg(*sums).where("lt > 0 and ln > 0"), "lefts")
    own = words.select("word", F.col("t").alias("wt"), F.col("n").alias("wn"), F.col("lefts").alias("wl"))
    own = own.join(sent(often.select("word").distinct()), "word", "left_semi")
    p = own.join(sent(lefts.join(sent(often), "left").where("lt > 0 and ln > 0")), "word")
    p = p.select("left", "word", "t", "n", "lt", "ln", "kt", "kn", "wt", "wn", "wl").mapInArrow(_pair_ratios(total), kind)
    (w, rare_words), (p, rare_pairs) = (_split(c.stored(x, name), MAX_ENTRIES) for x, name in ((w, "word_ratios"), (p, "bigram_ratios")))
    rare = [x for x in (rare_words, rare_pairs) if x is not None]
    return {
        "words": w.column("entry").to_numpy(), "word_llr": w.column("llr").to_numpy(),
        "pairs": p.column("entry").to_numpy(), "pair_llr": p.column("llr").to_numpy(),
        "rare": rare[0].union(rare[-1]) if len(rare) == 2 else rare[0] if rare else None,
    }


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: np.ndarray) -> np.ndarray:
    if not len(keys):
        return default
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], default)


def evidence(model: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray, rare: pa.ListArray | None = None) -> np.ndarray:
    """Per row: mean log-likelihood ratio of the whole text and of the most toxic window of each length.
    ``rare``: each row's entries that aren't in the model."""
    out = np.zeros((len(offsets) - 1, 1 + len(WINDOWS)))
    if rare is not None:
        bound = rare.offsets.to_numpy()
        keys, values = (rare.values.field(k).to_numpy() for k in range(2))
    for lo, hi, part, off in c.chunks(data, offsets):
        words, _, pairs, first = _grams(part, off)
        llr = _look_up(model["words"], model["word_llr"], words.view(np.int64), np.zeros(len(words)))
        if rare is not None:  # an entry has one ratio, whichever row brings it
            own, at = np.unique(keys[bound[lo] : bound[hi]], return_index=True)
            ratio = values[bound[lo] : bound[hi]][at]
            llr = _look_up(own, ratio, rare_key(words).view(np.int64), llr)
            llr = _look_up(own, ratio, pairs.view(np.int64), llr)
        llr = _look_up(model["pairs"], model["pair_llr"], pairs.view(np.int64), llr)
        run = np.concatenate([[0.0], np.cumsum(llr)])
        n = np.diff(first)
        out[lo:hi, 0] = (run[first[1:]] - run[first[:-1]]) / np.maximum(n, 1)
        full = n > 0
        for k, window in enumerate(WINDOWS if full.any() else ()):
            # windows that end at each word and start in its row
            begin = np.maximum(np.arange(len(words)) + 1 - window, np.repeat(first[:-1], n))
            out[lo:hi, 1 + k][full] = np.maximum.reduceat((run[1:] - run[begin]) / window, first[:-1][full])
    return out


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return _look_up(keys, np.ones(len(keys), bool), wanted, np.zeros(len(wanted), bool))


def _rare_of(sent, bits):
    """(id, key) of a text's words and bigrams that aren't in the model but may be in the table of rare ones, by a bitmap of its keys."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mask = sent.value, 32 * len(bits.value) - 1
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = c.texts_of(batch)
            for lo, hi, part, off in c.chunks(data, offsets):
                words, _, pairs, first = _grams(part, off)
                row = np.repeat(np.arange(lo, hi), np.diff(first))
                other = ~_among(model["pairs"], pairs.view(np.int64))
                alone = other & ~_among(model["words"], words.view(np.int64))
                keys = np.concatenate([pairs[other], rare_key(words[alone])]).view(np.int64)
                row = np.concatenate([row[other], row[alone]])
                may = c.in_filter(bits.value, keys & mask)
                keys, row = keys[may], row[may]
                order = np.lexsort((keys, row))
                keys, row = keys[order], row[order]
                new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])[: len(keys)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[row[new]]), pa.array(keys[new])], ["id", "key"])

    return rows


def with_rare(rows: DataFrame, model: dict, sent) -> DataFrame:
    """``rows`` (text, carried) and ``rare``, the entries of each text that aren't sent, from the table of them."""
    if model["rare"] is None:
        return rows.withColumn("rare", F.lit(None).cast("array<struct<key:bigint,llr:double>>"))
    spark = rows.sparkSession
    bits = spark.sparkContext.broadcast(_gram_filter(model["rare"].select(F.col("key").alias("grp"))))
    # equal texts have equal entries, so texts go by their hash; two texts that shared one would only get each other's entries too
    wanted = rows.select(F.xxhash64("text").alias("id"), "text").mapInArrow(_rare_of(sent, bits), "id long, key long")
    found = wanted.join(model["rare"], "key").groupBy("id").agg(F.collect_set(F.struct("key", "llr")).alias("rare"))
    found = c.stored(found, "rare")
    return rows.withColumn("id", F.xxhash64("text")).join(found, "id", "left").drop("id")


def _lists(rare: pa.Array) -> pa.ListArray | None:
    """Null and empty lists alike; None if no row has any."""
    return None if rare.null_count == len(rare) else rare


def _newton_sums(w: np.ndarray):
    """Gradient and curvature of the log loss at ``w``, summed over a task's rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) * (len(w) + 1))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                a, y = np.column_stack([np.ones(len(x)), x]), batch.column(1).to_numpy()
                p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
                total += np.concatenate([a.T @ (p - y), ((a * (p * (1 - p))[:, None]).T @ a).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], [f"s{k}" for k in range(len(total))])

    return rows


def fit_link(seen: DataFrame, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression of y by e over all rows of ``seen``, by Newton steps: bias and weights.
    A step brings one row of sums to the driver."""
    n = 2 + len(WINDOWS)
    w, ridge = np.zeros(n), np.diag([1e-6] + [1e-2] * (n - 1))
    names = [f"s{k}" for k in range(n * (n + 1))]
    for _ in range(rounds):
        parts = seen.mapInArrow(_newton_sums(w), ", ".join(f"{x} double" for x in names))
        sums = np.array(parts.agg(*[F.sum(x) for x in names]).first(), float)
        step = np.linalg.solve(sums[n:].reshape(n, n) + ridge, sums[:n] + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _evidence_rows(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = evidence(model.value, *c.texts_of(batch), _lists(batch.column(2)))
            yield pa.RecordBatch.from_arrays([pa.array(list(e), pa.list_(pa.float64())), batch.column(1)], ["e", "y"])

    return rows


def sent_part(model: dict) -> dict[str, np.ndarray]:
    return {k: v for k, v in model.items() if k != "rare"}


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The model, or None without labels of both classes."""
    known = known_labels(labels, "toxic")
    model = fit_models(labelled(docs, known.where("fold <> 4")))  # each text is read for one of the two, so none is stored
    if model is None:
        return None
    sent = docs.sparkSession.sparkContext.broadcast(sent_part(model))
    held = labelled(docs, known.where("fold = 4"))
    if model["rare"] is not None:
        held = c.stored(held, "held")  # its texts are read twice
    seen = c.stored(with_rare(held, model, sent).select("text", "y", "rare").mapInArrow(_evidence_rows(sent), "e array<double>, y int"), "evidence")
    if seen.agg(F.countDistinct("y")).first()[0] == 2:
        model["link"] = fit_link(seen)
    else:  # too few held-out rows: the evidence of the windows itself
        model["link"] = np.array([-float(max(WINDOWS)), 0.0, *[1.0] * len(WINDOWS)])
    return model


def score(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default) and ``toxicity_score`` (0 to 1)."""
    carry = [x for x in (carry or docs.columns) if x != "toxicity_score"]
    with c.small_batches(docs.sparkSession):
        model = fit(docs, labels)
    if model is None:
        return docs.select(*carry, F.lit(0.0).alias("toxicity_score"))
    sent = docs.sparkSession.sparkContext.broadcast(sent_part(model))
    # one struct, whatever the columns are called; the text crosses once
    given = docs.select(F.struct(*dict.fromkeys([*carry, "text"])).alias("carried"))
    if model["rare"] is None:
        given = given.select("carried", F.lit(None).cast("array<struct<key:bigint,llr:double>>").alias("rare"))
    else:
        with c.small_batches(docs.sparkSession):
            given = with_rare(given.withColumn("text", F.col("carried.text")), model, sent).select("carried", "rare")
    schema = docs.select(F.struct(*carry).alias("carried")).schema.add("toxicity_score", "double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            whole = batch.column(0)
            e = evidence(m, *c.texts_of(pa.RecordBatch.from_arrays([whole.field("text")], ["text"])), _lists(batch.column(1)))
            s = 1 / (1 + np.exp(-np.clip(m["link"][0] + e @ m["link"][1:], -30, 30)))
            kept = pa.StructArray.from_arrays([whole.field(x) for x in carry], names=carry)
            yield pa.RecordBatch.from_arrays([kept, pa.array(s)], ["carried", "toxicity_score"])

    return given.mapInArrow(rows, schema).select("carried.*", "toxicity_score")

import collections
import math
import re

import numpy as np
import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from ledgerloom.llm import lm_scoring, quality_mil, quality_rules, queries, toxicity
from ledgerloom.llm.common import WORD

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


# --- masked pseudo-likelihood

def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    net = {k: v.astype(float) for k, v in lm_scoring.start_network().items()}
    ids, around = rng.integers(0, lm_scoring.TOKENS, 60), rng.integers(0, lm_scoring.TOKENS + 1, (4, 60))
    slopes = lm_scoring.gradient(net, ids, around)
    for k, g in slopes.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        was, ends = net[k][at], []
        for d in (1e-5, -1e-5):
            net[k][at] = was + d
            ends.append(-lm_scoring.log_probabilities(net, ids, around).mean())
        net[k][at] = was
        assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(g[at], rel=1e-4)


def test_probabilities_sum_to_one_and_neighbours_stay_inside():
    net = lm_scoring.start_network()
    around = np.array([[1], [2], [3], [lm_scoring.TOKENS]])
    every = np.arange(lm_scoring.TOKENS)
    assert np.exp(lm_scoring.log_probabilities(net, every, np.repeat(around, len(every), 1))).sum() == pytest.approx(1, abs=1e-4)
    out = lm_scoring.TOKENS
    assert lm_scoring.neighbours(np.array([5, 6, 7]), np.array([0, 2, 2, 3])).T.tolist() == [[out, out, 6, out], [out, 5, out, out], [out] * 4]


def test_scores_of_all_cases(spark):
    docs, rows = documents(spark)
    got = lm_scoring.score(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(r[0]), len(re.findall(WORD, r[1] or ""))) for r in rows)
    assert all((r.log_prob < 0 and r.perplexity > 1) if r.n_tokens else (r.log_prob == 0 and r.mean_log_prob is None) for r in got)
    assert lm_scoring.score(empty(spark)).count() == 0


def test_training_learns_from_the_neighbours(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BATCH", 64)
    docs = spark.createDataFrame([(k, "the cat sat on the mat and the dog sat on the rug " * 40) for k in range(60)], "doc_id long, text string").coalesce(1)
    best = lm_scoring.score(docs).first()
    assert best.mean_log_prob > -1.5  # eight words that follow one another: the neighbours tell which


def test_each_position_is_trained_once(spark):
    docs, rows = documents(spark)
    context, words = spark.sparkContext, np.zeros(0, np.uint64)
    sent, net = context.broadcast(words), context.broadcast(lm_scoring.flat(lm_scoring.start_network()))
    texts = docs.select("text", F.xxhash64("doc_id").alias("key"))
    trained = [texts.mapInArrow(lm_scoring._train(sent, net, turn), "piece int, task int, v array<float>, n long").where("piece = 0").agg(F.sum("n")).first()[0] for turn in range(lm_scoring.ROUNDS)]
    assert sum(trained) == sum(len(re.findall(WORD, r[1] or "")) for r in rows) and min(trained) > 0


def test_copies_of_a_text_are_masked_apart():
    hashes = np.tile(np.arange(500, dtype=np.uint64), 2)
    turn = lm_scoring.round_of(hashes, np.array([0, 500, 1000]), np.array([3, 4], np.uint64))
    assert set(turn) == set(range(lm_scoring.ROUNDS)) and 100 < (turn[:500] != turn[500:]).sum() < 400


@pytest.mark.parametrize("head", [0, 40, 1 << 17])
def test_rare_words_have_their_own_probability(spark, monkeypatch, head):
    """Outside the vocabulary a word's count within its bucket decides, by lookup and by join alike."""
    common = " ".join(f"top{k}" for k in range(lm_scoring.TOKENS - lm_scoring.BUCKETS))
    names = [f"rare{k}" for k in range(600)]
    texts = [" ".join([common] * 40)] + [" ".join([w] * (1 + k % 30)) for k, w in enumerate(names)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    vocab, net = [], []
    real, learn = lm_scoring.vocabulary, lm_scoring.train
    monkeypatch.setattr(lm_scoring, "vocabulary", lambda *a: vocab.append(real(*a)) or vocab[0])
    monkeypatch.setattr(lm_scoring, "train", lambda *a: net.append(learn(*a)) or net[0])
    got = {r.doc_id: r.log_prob for r in lm_scoring.score(docs).collect()}
    hashes = lambda t: lm_scoring._hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
    totals = np.zeros(lm_scoring.BUCKETS)
    bucket = {k: int(lm_scoring.bucket_of(hashes(w)[0])[0]) for k, w in enumerate(names)}
    for k, b in bucket.items():
        totals[b] += 1 + k % 30
    words, own = lm_scoring._Vocabulary(vocab[0]), lm_scoring.unflat(net[0])
    for k in range(len(names)):
        h, first = hashes(texts[k + 1])
        ids = words.ids(h)
        assert (ids == bucket[k]).all()
        n = 1 + k % 30
        want = lm_scoring.log_probabilities(own, ids, lm_scoring.neighbours(ids, first)).sum() + n * np.log(n / totals[bucket[k]])
        assert got[k + 1] == pytest.approx(want, abs=1e-4)


# --- toxicity

def test_toxicity_learns_only_outside_the_held_out_fold(spark):
    """Separable words, measured on documents whose labels weren't read."""
    import random
    rng = random.Random(2)
    rows, marks = [], []
    for k in range(1500):
        bad = rng.random() < 0.3
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(10, 60))]
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["awful", "nasty"])
        rows.append((k, " ".join(words), 0))
        marks.append((k, 1, int(bad), "clash"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    got = toxicity.score(docs, labels(spark, marks)).withColumn("held", toxicity.fold_of(F.col("doc_id")) == 0).toPandas()
    truth = {m[0]: m[2] for m in marks}
    held = got[got.held]
    assert len(held) > 200 and got.columns.tolist()[:3] == ["doc_id", "text", "y"]
    assert ((held.toxicity_score >= 0.5).astype(int) == held.doc_id.map(truth)).mean() > 0.97
    # labels of the held-out fold change nothing
    turned = [(d, q, 1 - t if (d in set(held.doc_id)) else t, x) for d, q, t, x in marks]
    again = toxicity.score(docs, labels(spark, turned)).toPandas().set_index("doc_id").toxicity_score
    assert np.allclose(again[held.doc_id].to_numpy(), held.toxicity_score.to_numpy())


def test_toxicity_learns_from_every_label(spark):
    """A word with the least contexts that count, each in one of 24,000 labelled documents."""
    import zlib
    counted = [k for k in range(24_000) if zlib.crc32(str(k).encode()) % 5 in (1, 2, 3)]
    bad = counted[:: len(counted) // toxicity.MIN_COUNT][: toxicity.MIN_COUNT]
    docs = spark.range(24_000).selectExpr("id as doc_id", f"concat('w', id, if(id in ({', '.join(map(str, bad))}), ' vile', ' mild')) as text")
    marks = docs.selectExpr("doc_id", "cast(text like '% vile' as int) as toxic")
    data = np.frombuffer(b"vile", np.uint8)
    vile = toxicity.c.span_hashes(data, np.array([0]), np.array([4])).view(np.int64)[0]
    model = toxicity.fit(docs, marks)
    assert vile in model["words"] and model["word_llr"][model["words"] == vile][0] > 0


def test_toxicity_brings_words_together_once(spark):
    """Labelled texts are not stored, and of the words only those that are kept are, with one row of sums."""
    import os
    docs = spark.range(400).selectExpr("id as doc_id", "concat('a', id, ' good b', id, if(id % 2 = 0, ' mild', ' vile')) as text")
    marks = docs.selectExpr("doc_id", "cast(text like '% vile' as int) as toxic")
    with toxicity.c.recorded() as paths:
        model = toxicity.fit(docs, marks)
    written = {os.listdir(p)[0]: os.path.join(p, os.listdir(p)[0]) for p in (x.removeprefix("file://") for x in paths)}
    assert "sample" not in written
    words = spark.read.parquet(written["words"]).collect()
    assert {r.word for r in words} == {*model["words"].tolist(), None} and len(words) == 4
    rest = next(r for r in words if r.word is None)
    n = sum(1 for r in marks.select(toxicity.fold_of(F.col("doc_id")).alias("f")).collect() if r.f in (1, 2, 3))
    assert rest.k == rest.t + rest.n == 2 * n  # an own first word and an own third word in each text


def test_toxicity_joins_small_batches():
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"text": ["x" * 10] * 3}) for _ in range(5)]
    got = [b.num_rows for b in toxicity._gathered(iter(batches), 2 * batches[0].nbytes)]
    assert got == [6, 6, 3] and [b.num_rows for b in toxicity._gathered(iter(batches), 1)] == [3] * 5
    assert list(toxicity._gathered(iter([]), 1)) == []


def test_toxicity_keeps_what_is_too_many_to_be_sent(spark, monkeypatch):
    """With room for three words and three bigrams the others are joined: no score differs. Texts repeat, are null and empty."""
    import random
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("red", "blue", "grey", "vile bad", "mild good", "so", f"w{rng.randint(0, 20)}")) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None, "", *texts[:5]])], "doc_id long, text string")
    marks = labels(spark, [(k, 1, int("vile" in t), None) for k, t in enumerate(texts)])
    scores = lambda: {r.doc_id: r.toxicity_score for r in toxicity.score(docs, marks, ["doc_id"]).collect()}
    want, model = scores(), toxicity.fit(docs, marks)
    assert model["rare"] is None
    monkeypatch.setattr(toxicity, "MAX_ENTRIES", 3)
    cut = toxicity.fit(docs, marks)
    assert len(cut["words"]) <= 3 and len(cut["pairs"]) <= 3
    assert len(cut["words"]) + len(cut["pairs"]) + cut["rare"].count() == len(model["words"]) + len(model["pairs"]) > 30
    got = scores()
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()))


def test_toxicity_keeps_bigrams_of_words_with_one_left_word(spark):
    """The last word of a fixed phrase has one context, the phrase as many as there are words before it."""
    docs = spark.range(120).selectExpr("id as doc_id", "concat('w', id % 40, ' fixed ', if(id % 2 = 0, 'phrase', 'saying')) as text")
    marks = docs.selectExpr("doc_id", "cast(text like '%phrase' as int) as toxic")
    model = toxicity.fit(docs, marks)
    hashes = lambda t: toxicity.c.span_hashes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))
    gram = toxicity.gram_of(hashes(b"fixed"), hashes(b"phrase")).view(np.int64)[0]
    assert hashes(b"phrase").view(np.int64)[0] not in model["words"]
    assert gram in model["pairs"] and model["pair_llr"][model["pairs"] == gram][0] > 0


def test_toxicity_cases(spark):
    docs, rows = documents(spark)
    some = labels(spark, [(k, 1, int(k % 3 == 0), None) for k in range(40)] + [(0, 1, 0, None), (None, None, None, None)])
    got = toxicity.score(docs, some)
    assert got.count() == len(rows) and got.where("toxicity_score between 0 and 1").count() == len(rows)
    blank = {r.toxicity_score for r in got.where("text is null or text = ''").collect()}
    assert len(blank) == 1
    assert toxicity.score(docs, labels(spark, [])).where("toxicity_score = 0").count() == len(rows)
    assert toxicity.score(empty(spark), some).count() == 0


# --- quality rules

def brute_counts(text):
    text = text or ""
    w = re.findall(WORD, text)
    tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    cover = {p for k, t in enumerate(tri) if tri.count(t) > 1 for p in range(k, k + 3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def test_base_counts_against_brute_force(spark):
    docs, rows = documents(spark)
    more = ["a\nb\na\n\n \n a\na", "x y z x y z", "é é é é", "### <b>|| ä&ö\n### <b>|| ä&ö", "a b c " * 30]
    rows = [r for r in rows if len(r[1] or "") < 3000] + [(900 + k, t) for k, t in enumerate(more)]
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    got = quality_rules.judge(docs, labels(spark, [(k, 1, 0, None) for k in range(40)])).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == sorted(
        ((r[0], *brute_counts(r[1])) for r in rows), key=key
    )
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert not any(r.kept and r.base_failed for r in got)


def test_ratio_is_the_mean_log_likelihood_ratio():
    raw, trusted = np.zeros(quality_rules.BINS), np.zeros(quality_rules.BINS)
    raw[:4], trusted[:4] = [90, 5, 4, 1], [0, 80, 9, 1]
    llr = quality_rules.log_ratio(raw, trusted)
    p = (raw + 0.5) / (raw.sum() + 0.5 * quality_rules.BINS)
    q = (trusted + 0.5 * quality_rules.BINS * p) / (trusted.sum() + 0.5 * quality_rules.BINS)
    assert np.allclose(llr, np.log(q / p)) and q.sum() == pytest.approx(1) and llr[1] > 0 > llr[0]


def test_quality_rules_without_trusted_documents_and_empty(spark):
    docs, _ = documents(spark)
    got = quality_rules.judge(docs, labels(spark, []))
    assert got.where("kept = base_failed").count() == 0
    assert quality_rules.judge(empty(spark), labels(spark, [])).count() == 0


@pytest.mark.parametrize("most", [1 << 28, 1 << 6])
def test_target_and_threshold_cover_every_trusted_document(spark, monkeypatch, most):
    monkeypatch.setattr(quality_rules, "MOST_FILTER_BITS", most)
    tails = [" ".join(f"v{k}x{j}" for j in range(50)) for k in range(5)] + [""]  # without a tail a base rule fails
    texts = [f"w{k % 97} w{k % 89} w{k % 7} w{k % 7} {tails[k % 6]}" for k in range(30_000)]
    docs = spark.createDataFrame([*enumerate(texts), (5, texts[6]), (None, "w1 w2")], "doc_id long, text string")
    marks = labels(spark, [(k, int(k % 4 != 0), 0, None) for k in range(30_000)] + [(5, 1, 0, None), (None, 1, 0, None)])
    good = {r.doc_id for r in marks.where((F.col("quality") == 1) & (toxicity.fold_of(F.col("doc_id")) != 0)).collect()} - {None}
    assert len(good) > 16_000

    def bins(own):
        raw = [x.encode() for x in own]
        return quality_rules.gram_bins(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))[0]

    count = lambda own: np.bincount(bins(own), minlength=quality_rules.BINS).astype(float)
    mine = [texts[k] for k in sorted(good)] + [texts[6]] * (5 in good)
    raw, trusted = count([*texts, texts[6], "w1 w2"]), count(mine)
    ids = quality_rules.trusted_ids(docs, marks)
    target, threshold = quality_rules.fit(docs, ids, *quality_rules.filter_of(ids))
    assert np.allclose(target[0], quality_rules.log_ratio(raw, trusted), atol=1e-12) and (target[2] == trusted).all()

    smooth = quality_rules.PRIOR * quality_rules.BINS
    p = (raw + quality_rules.PRIOR) / (raw.sum() + smooth)

    def without(text):
        own = collections.Counter(bins([text]).tolist())
        n = own.total()
        return sum(c * math.log((trusted[b] - c + smooth * p[b]) / (trusted.sum() - n + smooth) / p[b]) for b, c in own.items()) / n

    want = {t: without(t) for t in set(mine)}
    r = np.array([want[t] for t in mine if len(t.split()) >= 50])
    assert 0 < len(r) < len(mine)
    assert threshold == pytest.approx(r.mean() - quality_rules.SPREADS * r.std(), abs=1e-9)
    plain = quality_rules.log_ratio(raw, trusted)
    for row in quality_rules.judge(docs, marks).where("doc_id % 100 < 9").collect():
        text = {texts[row.doc_id], texts[6] if row.doc_id == 5 else texts[row.doc_id]}
        is_right = lambda t: row.ratio == pytest.approx(want[t] if row.doc_id in good else plain[bins([t])].mean(), abs=1e-9)
        assert any(map(is_right, text))


def test_quality_verdict_does_not_depend_on_a_read_label(spark):
    """Good documents are kept alike, whether their label was read or held out."""
    got = queries.QUERIES["op8_quality_rules"](spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    fold = {r.doc_id: r.f for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", toxicity.fold_of(F.col("doc_id")).alias("f")).collect()}
    passed = got[(got.quality == 1) & ~got.base_failed]
    read = passed.doc_id.map(fold) != 0
    assert read.sum() > 100 and (~read).sum() > 30
    assert abs(passed[read].kept.mean() - passed[~read].kept.mean()) < 0.03
    assert abs(passed[read].ratio.mean() - passed[~read].ratio.mean()) < 0.05


# --- multiple-instance quality

def test_mil_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    x, at, y = rng.normal(size=(12, quality_mil.N_FEATURES)), np.array([0, 1, 4, 9, 12]), np.array([0.0, 1, 1, 0])
    w = {k: np.array(v) for k, v in quality_mil.train(x, at, y).items()}
    loss = lambda: -np.mean(np.log(np.where(y == 1, s := quality_mil._forward(w, x, at)["s"], 1 - s)))
    for k, g in quality_mil._gradient(w, x, at, y).items():
        i = np.unravel_index(np.abs(g).argmax(), np.shape(g))
        was, ends = w[k][i].copy(), []
        for d in (1e-5, -1e-5):
            w[k][i] = was + d
            ends.append(loss())
        w[k][i] = was
        assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(g[i], rel=1e-3, abs=1e-9)


def test_mil_trains_on_every_passage(monkeypatch):
    import pyarrow as pa
    texts = ["word " * 64 * 300, "few words", "more " * 64 * 70]
    bag = next(quality_mil._bags(iter([pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1, 0, 1], pa.int32())], ["text", "y"])])))
    assert [len(x) // quality_mil.N_FEATURES for x in bag.column(0).to_pylist()] == [300, 1, 70]
    monkeypatch.setattr(quality_mil, "STEP_PASSAGES", 10)
    sizes = np.array([4, 300, 6, 4, 1, 1])
    got = [list(b) for b in quality_mil._steps(np.array([0, 2, 1, 3, 4, 5]), sizes)]
    assert got == [[0, 2], [1], [3, 4, 5]]


def test_mil_held_out_accuracy(spark):
    got = queries.QUERIES["op9_quality"](spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() >= 0.95


def test_mil_cases(spark):
    docs, rows = documents(spark)
    some = labels(spark, [(k, int(k % 2), 0, None) for k in range(40)])
    got = quality_mil.score(docs, some)
    assert got.count() == len(rows) and got.where("score between 0 and 1").count() == len(rows)
    assert quality_mil.score(docs, labels(spark, [])).where("score = 0.5").count() == len(rows)
    assert quality_mil.score(empty(spark), some).count() == 0

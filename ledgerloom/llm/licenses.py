"""Licence scan by a positional rare-token index (native DataFrame operations).

The index holds, for every word of the licence templates, its places
(template, position). A file's licence words are found with their positions;
their document frequencies over all files give the IDF. Of each file the words
that are among a template's highest-IDF ones are looked up: a word at position i
with a posting (t, p) votes for template t laid at i - p. Of every template so
many words are looked up that the others don't make ``ENOUGH`` of its IDF weight,
so no lay with that much goes without a vote. All words of the lay then score it;
a lay with ``ENOUGH`` is verified by the template's mandatory key phrases
standing within it.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.

Cases: null or empty text has no words, no labels and score 0; repeated rows
and repeated doc_ids each keep their row; texts of any length are read whole;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored, text_or_empty

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: label, notice, mandatory key phrases.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license", "version 2")),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ("public domain", "cc0")),
    ("proprietary", "copyright all rights reserved", ("all rights reserved",)),
)
#: Share of a template's weight that a lay must hold.
ENOUGH = 0.6
#: Slack of bounds against sums rounded to six digits.
SLACK = 1e-6


def _vocabulary(templates, base) -> list[str]:
    return sorted({w for _, notice, _ in templates for w in notice.split()} | {w for p, _ in base for w in p.split()})


def _rare_places(words: list[str], idf: dict, unseen: float) -> list[int]:
    """Places of a notice's highest-IDF words, as many as make a lay without any of them fall short of ``ENOUGH``."""
    weight = [idf.get(w, unseen) for w in words]
    out, left = [], (1 - ENOUGH + SLACK) * sum(weight)
    for p in sorted(range(len(words)), key=lambda p: (-weight[p], p)):
        if left < 0:
            break
        out.append(p)
        left -= weight[p]
    return out


def _phrase_starts(hits: Column, phrase: str) -> Column:
    """Positions where the phrase's words stand consecutively; ``hits`` holds
    all places (i, w) of licence words in order, so they are neighbours there."""
    words = phrase.split()

    def stands(x: Column, j: Column) -> Column:
        ok = x["w"] == words[0]
        for k, w in enumerate(words[1:], 1):
            nxt = F.get(hits, j + k)
            ok = ok & F.coalesce((nxt["w"] == w) & (nxt["i"] == x["i"] + k), F.lit(False))
        return ok

    return F.transform(F.filter(hits, stands), lambda x: x["i"])


def _within(n: int):
    return lambda i: (i >= F.col("at")) & (i < F.col("at") + n)


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the lays found."""
    spark = docs.sparkSession
    vocabulary = _vocabulary(templates, base)
    words = F.regexp_extract_all(lower_ascii(text_or_empty(F.col("text"))), F.lit(LICENSE_WORD), F.lit(0))
    placed = F.transform(F.col("words"), lambda w, i: F.struct(i.cast("long").alias("i"), w.alias("w")))
    files = docs.select("doc_id", words.alias("words")).select(
        F.monotonically_increasing_id().alias("file"), "doc_id", F.size("words").cast("long").alias("n_words"),
        F.filter(placed, lambda x: x["w"].isin(*vocabulary)).alias("hits"),
    )
    files = files.withColumn("own", F.array_distinct(F.transform("hits", lambda x: x["w"])))
    files = stored(files, "license_words")

    # IDF of the licence words: at most one row per vocabulary word
    n_files = files.count()
    seen = files.select(F.explode("own").alias("w")).groupBy("w").count()
    df = {r["w"]: r["count"] for r in seen.collect()}
    idf = {w: math.log1p(n_files / df[w]) for w in vocabulary if w in df}
    unseen = math.log1p(n_files)
    notices = [notice.split() for _, notice, _ in templates]
    rare = [_rare_places(ws, idf, unseen) for ws in notices]
    postings = [(ws[p], idf[ws[p]], t, p) for t, ws in enumerate(notices) for p in rare[t] if ws[p] in idf]
    index = spark.createDataFrame(postings or [("", 0.0, -1, 0)], "w string, idf double, t int, p long")
    weight = [sum(idf.get(w, unseen) for w in ws) for ws in notices]

    # a template can only reach ENOUGH in a file that has that weight of its words somewhere; rest: what its other words may add to the votes
    able = []
    for t, ws in enumerate(notices):
        has = [F.when(F.array_contains("own", w), F.lit(idf.get(w, 0.0))).otherwise(0.0) for w in ws]
        rest = sum((has[p] for p in range(len(ws)) if p not in rare[t]), F.lit(0.0))
        able.append(F.when(sum(has, F.lit(0.0)) >= (ENOUGH - SLACK) * weight[t], F.struct(F.lit(t).alias("t"), rest.alias("rest"))))
    scored = files.where("size(own) > 0").withColumn("able", F.filter(F.array(*able), lambda x: x.isNotNull()))
    # few bytes but much work a row: dealt by file over all tasks, which the groups below keep
    scored = scored.where("size(able) > 0").select("file", "able", "hits").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")
    votes = scored.withColumn("x", F.explode("hits")).join(F.broadcast(index), F.col("x.w") == F.col("w"))
    votes = votes.withColumn("able", F.get(F.filter("able", lambda x: x["t"] == F.col("t")), F.lit(0))).where("able is not null")
    whole = F.element_at(F.array(*[F.lit(w) for w in weight]), F.col("t") + 1)
    lays = (
        votes.groupBy("file", "t", (F.col("x.i") - F.col("p")).alias("at"))
        .agg((F.sum("idf") + F.max("able.rest")).alias("most"))
        .where(F.col("most") >= (ENOUGH - SLACK) * whole)
    )

    # all words of the lay score it
    notice = F.element_at(F.array(*[F.array(*map(F.lit, ws)) for ws in notices]), F.col("t") + 1)
    weigh = F.create_map(*[x for w in idf for x in (F.lit(w), F.lit(idf[w]))]) if idf else F.create_map(F.lit(""), F.lit(0.0))
    inside = F.filter("hits", lambda x: (x["i"] >= F.col("at")) & (x["i"] < F.col("at") + F.size("notice")))
    fits = F.filter(inside, lambda x: F.get(F.col("notice"), (x["i"] - F.col("at")).cast("int")) == x["w"])
    got = F.aggregate(fits, F.lit(0.0), lambda sofar, x: sofar + weigh[x["w"]])
    lays = lays.join(files.select("file", "hits"), "file").withColumn("notice", notice)
    lays = lays.withColumn("share", F.round(got / whole, 6)).where(F.col("share") >= ENOUGH)

    # verify the mandatory phrases inside the lay
    ok = F.lit(False)
    for t, (_, notice, phrases) in enumerate(templates):
        every = F.lit(True)
        for p in phrases:
            every = every & F.exists(_phrase_starts(F.col("hits"), p), _within(len(notice.split())))
        ok = F.when(F.col("t") == t, every).otherwise(ok)
    name = F.element_at(F.array(*[F.lit(label) for label, _, _ in templates]), F.col("t") + 1)
    verified = lays.where(ok).groupBy("file").agg(
        F.collect_set(name).alias("names"), F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("at", name.alias("label"), "share"))).alias("lays"),
    )

    out = files
    for k, (phrase, _) in enumerate(base):
        out = out.withColumn(f"b{k}", _phrase_starts(F.col("hits"), phrase))
    starts = F.flatten(F.array(*[F.col(f"b{k}") for k in range(len(base))]))
    labels = F.filter(F.array(*[F.when(F.size(f"b{k}") > 0, label) for k, (_, label) in enumerate(base)]), lambda x: x.isNotNull())
    out = out.withColumn("starts", starts).withColumn("base", F.array_sort(F.array_distinct(labels))).join(verified, "file", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("names", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "lays",
    )

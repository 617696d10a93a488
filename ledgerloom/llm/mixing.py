"""Mixing sources to target weights (native DataFrame operations only).

A low-discrepancy schedule decides which source fills each slot of the mix:
slot k maps the golden-ratio point frac(k * phi) through the cumulative target
weights. Each source's documents are shuffled by a hash of their id, laid out
as one stream of words and cut into equal blocks; the r-th slot of a source
takes its block r modulo the number of blocks, so a source is repeated in
whole passes, never more than two.

Nothing is ordered in one task: a source's stream is laid out in hash bins of
about ``BIN_DOCS`` documents (offsets come from the bins' totals), and slots
are ranked in runs of ``RUN_SLOTS`` (offsets from the runs' counts). A source
with a third of all rows is spread over its bins, runs and blocks.

Cases: null text has size 0; a null source is a source of its own, ordered
last; documents of size 0 take nothing; rows that repeat a doc_id share their
place in the shuffle and each keep their own row; an empty table gives an
empty mix; other columns of ``docs`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored, text_or_empty

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix holds this multiple of all words.
SHARE = 1.5
#: No source (and no document) is taken more often than this.
MAX_PASSES = 2
#: Words in a block at most, and blocks of a source at least.
BLOCK_WORDS, MIN_BLOCKS = 256, 256
BIN_DOCS, RUN_SLOTS, CELLS = 4096, 16384, 1024
#: Odd multiplier next to 2^31 / golden ratio: k * GOLDEN mod 2^31 are the golden-ratio points.
GOLDEN, POINTS = 1327217885, 2147483648
#: 2^32, the range of the shuffle hash.
HASHES = 4294967296


def _shuffle_hash(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, shuffle hash and the row's number among equals."""
    size = F.regexp_count(text_or_empty(F.col("text")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), _shuffle_hash(F.col("doc_id")).alias("h"))


def targets(rows: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """One row per source: words, documents, target and blocks.

    The level L solves sum(min(cap, L * weight)) = budget, where the repeated
    stopping and resharing ends: sources ordered by cap / weight, the first
    whose own level is within its cap sets L.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "code")
    rest = by_room.rowsBetween(0, Window.unboundedFollowing)
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("code", F.row_number().over(by_code))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("code") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", (MAX_PASSES * F.col("source_size")).cast("double"))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("own", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("level", F.min(F.when(F.col("own") <= F.col("room"), F.struct("room", "code", "own"))).over(everything)["own"])
    )
    target = F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap"))
    return per.select(
        "source", "code", "source_size", "n_docs", target.alias("target"),
        # equal blocks: as many as keep a block within BLOCK_WORDS, MIN_BLOCKS at least where there are so many words
        F.greatest(F.ceil(F.col("source_size") / BLOCK_WORDS), F.least(F.col("source_size"), F.lit(MIN_BLOCKS))).cast("long").alias("n_blocks"),
    )


def schedule(sources: DataFrame) -> DataFrame:
    """code, block, times: how often the slots of the mix take each block."""
    spark = sources.sparkSession
    slots_of = F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0)
    w = Window.orderBy("code")
    share = (
        sources.withColumn("slots", slots_of)
        .withColumn("upto", F.sum("slots").over(w))
        .withColumn("total", F.sum("slots").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .where("slots > 0")
        .withColumn("lo", (F.col("upto") - F.col("slots")) / F.col("total"))
        .withColumn("hi", F.when(F.col("upto") >= F.col("total") * (1 - 1e-12), 2.0).otherwise(F.col("upto") / F.col("total")))
        .select("code", "n_blocks", "lo", "hi", "total")
    )
    total = share.agg(F.max("total")).first()[0]  # one number
    n_slots = int(total + 0.5) if total else 0
    point = F.pmod(F.pmod(F.col("k"), F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS)) / F.lit(float(POINTS))
    slots = spark.range(n_slots).select(F.col("id").alias("k")).withColumn("u", point)
    # the source whose interval holds the point: an equi-join on CELLS cells of [0, 1), then the exact bounds
    cell = lambda x: F.floor(F.least(x, F.lit(1.0 - 1e-12)) * CELLS)
    spread = share.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    slots = slots.withColumn("cell", cell(F.col("u"))).join(spread, "cell").where("lo <= u and u < hi").select("k", "code", "n_blocks")
    runs = slots.withColumn("run", F.floor(F.col("k") / RUN_SLOTS))
    counted = runs.groupBy("code", "run").count()
    first = F.sum("count").over(Window.partitionBy("code").orderBy("run")) - F.col("count")
    offsets = counted.select("code", "run", first.alias("first"))
    ranked = runs.withColumn("i", F.row_number().over(Window.partitionBy("code", "run").orderBy("k")) - 1).join(offsets, ["code", "run"])
    rank = F.col("first") + F.col("i")
    return (
        ranked.withColumn("rank", rank)
        .where(F.col("rank") < MAX_PASSES * F.col("n_blocks"))
        .select("k", "code", "n_blocks", F.pmod(F.col("rank"), F.col("n_blocks")).alias("block"), F.floor(F.col("rank") / F.col("n_blocks")).alias("pass"))
    )


def layout(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's place [at, at + size) in its source's shuffled stream."""
    keyed = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "size", "h", "code", "source_size", "target", "n_blocks",
        F.floor(F.col("h") / F.lit(float(HASHES)) * F.ceil(F.col("n_docs") / BIN_DOCS)).alias("bin"),
    )
    bins = keyed.groupBy("code", "bin").agg(F.sum("size").alias("words"))
    before = bins.select("code", "bin", (F.sum("words").over(Window.partitionBy("code").orderBy("bin")) - F.col("words")).alias("bin_at"))
    order = Window.partitionBy("code", "bin").orderBy("h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    return keyed.withColumn("upto", F.sum("size").over(order)).join(before, ["code", "bin"]).withColumn("at", F.col("bin_at") + F.col("upto") - F.col("size"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE) -> tuple[DataFrame, DataFrame]:
    """(documents with size, source_size, target, taken; pieces of the mix).

    The pieces (k, pass, doc_id, code, first_word, words) in the order of k are
    the mix: slot k takes ``words`` words of the document from ``first_word``.
    """
    rows = stored(sized(docs), "sized")
    sources = stored(targets(rows, weights, share), "sources")
    slots = stored(schedule(sources), "slots")
    placed = layout(rows, sources).withColumn("row", F.monotonically_increasing_id())
    placed = stored(placed.select("row", "doc_id", "size", "at", "code", "source_size", "target", "n_blocks"), "layout")
    # block b holds the words [floor(b * S / n), floor((b + 1) * S / n)) of the stream
    start = lambda b: F.expr(f"{b} * source_size div n_blocks")
    block_of = lambda w: F.expr(f"(({w} + 1) * n_blocks + source_size - 1) div source_size - 1")
    parts = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(block_of("at"), block_of("(at + size - 1)"))))
        .withColumn("from", F.greatest(start("block"), F.col("at")))
        .withColumn("words", F.least(start("(block + 1)"), F.expr("at + size")) - F.col("from"))
        .select("row", "doc_id", "code", "block", (F.col("from") - F.col("at")).alias("first_word"), "words")
    )
    pieces = slots.select("k", "code", "block", "pass").join(parts, ["code", "block"])
    times = slots.groupBy("code", "block").agg(F.count("*").alias("times"))
    got = parts.join(times, ["code", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = placed.join(got, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    return out, pieces

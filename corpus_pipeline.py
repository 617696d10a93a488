"""A training-corpus pipeline over ``documents``.

STAGES holds (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; the last returns
the mix, a row per document with the words taken from it.

None of the stages can be stated in SQL as a whole, so ORACLE_SQL is None; the
tests hold the stages against brute force.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontam, mixing, ngram_join, suffix_dedup, toxicity
from ledgerloom.llm.common import BATCH_ROWS, recorded, release, shared_dir, table

ORACLE_SQL = None
#: Documents with at least this toxicity score go.
TOXIC = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Working tables of the stage before, whose result is written when the next one begins.
_last: list[str] = []


def _stage(work: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _last)
        _last.clear()
        # a stage's result is evaluated by its caller, so batches are set for the session
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        with recorded() as paths:
            out = work(spark, docs, sf_dir)
        _last.extend(paths)
        return out

    return run_stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("toxicity_score") < TOXIC).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; the document with the smallest id of each group stays."""
    return ngram_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents keep what no other place repeats; null texts stay null."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    # the other columns travel as one, so their names can't meet the operator's
    row = F.struct(*rest).alias("row")
    cut = suffix_dedup.dedupe(docs.select("doc_id", "text", row, F.col("text").isNull().alias("no_text")), ["row", "no_text"])
    text = F.when(~F.col("no_text"), F.col("kept"))
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)[0]


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _stage(reject_toxic)),
    ("ngram_jaccard_join", _stage(drop_near_copies)),
    ("suffix_array_dedup", _stage(cut_repeats)),
    ("benchmark_decontamination", _stage(drop_leaks)),
    ("source_mixing", _stage(mix_sources)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.option("compression", "zstd").parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs

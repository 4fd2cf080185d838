"""A training corpus from raw documents: five stages, each an operator of ``faunagrid.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents, others of any names among them. A stage's result must be written before the
next stage is called, as ``run`` does: it writes each as Parquet on shared storage and reads it again. An empty table passes all stages.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faunagrid.llm import bpe, lines, mixing, near, quality
from faunagrid.llm.storage import stored, table
from faunagrid.scratch import drop_path, new_path, noted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No stage after the first can be told in SQL; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


#: Pre-tokens that a worker remembers in the last stage: fewer, since it comes after others that have filled the executors.
REMEMBERED = 200_000
_left: list[str] = []


def stage(function: Stage) -> Stage:
    """A stage that first drops the intermediate results of the stage before, whose rows are written by now."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            drop_path(spark, _left.pop())
        with noted() as paths:
            found = function(spark, docs, sf_dir)
        _left.extend(paths)
        return found

    return run_stage


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject.

    A null text is scored as the empty one; without labels of both kinds all documents have one score.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("text", F.struct("*").alias("_row"))
    return quality.score(rows, model).where(F.col("score") >= quality.THRESHOLD).select("_row.*")


@stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more share, but for one of each.

    A null text becomes the empty one; a row without an id keeps all its lines; rows of one id are one document.
    """
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return lines.dedup_lines(rows).select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


@stage
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest.

    Rows without an id stay; empty texts are no copies; rows that repeat an id and its text stay once.
    """
    linked = near.link(docs)
    kept = linked.where("id = component_id").select(F.col("id").alias("_kept")).distinct()
    again = linked.groupBy("id").count().where("id IS NOT NULL AND count > 1").select(F.col("id").alias("_again"))
    found = docs.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi")
    once = found.join(again, F.col("doc_id") == F.col("_again"), "left_anti")
    repeated = found.join(again, F.col("doc_id") == F.col("_again"), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated).unionByName(docs.where("doc_id IS NULL"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    Rows without an id, or with equal ones, are each for themselves; a null source is one; rows without words go.
    """
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    times = F.floor(F.col("taken") / F.col("size")).cast("int")
    mixed = mixing.mix(rows, row="_row").where("taken > 0").select("_row", times.alias("_times"))
    return rows.join(mixed, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(docs.columns)


@stage
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the bytes that they decode to; a null text has no tokens."""
    return bpe.round_trip(docs, *bpe.vocabulary(), remembered=REMEMBERED)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", keep_one_of_near_copies),
    ("source_mix", mix_sources),
    ("tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs

"""The training-data pipeline: quality, exact and near duplicates, benchmark passages, tokens.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage
before it kept, and all but the last return the columns of ``documents`` as they
were.  ``run`` writes each stage's rows to the shared work folder and reads them
back for the next one, so a lost executor costs one stage at most.

Defined results: rows with null texts count as empty texts in every stage;
repeated rows (one id, one text) leave the duplicate stages once; a row
with a null id is treated like any other; empty tables give empty stages; extra
columns of ``documents`` stay, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparecast.llm.bpe import verified_tokens
from sparecast.llm.common import bounded_batches, stored, table, work_folder
from sparecast.llm.decontaminate import decontaminated
from sparecast.llm.exact_dedup import drop_exact_duplicates
from sparecast.llm.near_dedup import drop_near_duplicates
from sparecast.llm.quality import fit, grade_of_labels, held_out, select_by_quality
from sparecast.llm.queries import importable, tokenizer_file


#: Python workers live on from stage to stage.  Under these settings of the allocators they give freed
#: memory back, so what one stage's batches took does not stay beside the next one's tables.
LEAN_WORKERS = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def lean(stage: Stage) -> Stage:
    """``stage`` with Python workers that keep little memory; values that the session sets itself hold, and other jobs see none of it.

    Its batches are bounded in bytes (``bounded_batches``: a setting that stays with the session).
    """

    @functools.wraps(stage)
    def run_lean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        environment = spark.sparkContext.environment
        added = {k: v for k, v in LEAN_WORKERS.items() if k not in environment}
        environment.update(added)
        try:
            return stage(spark, docs, sf_dir)
        finally:
            for k in added:
                environment.pop(k, None)

    return run_lean


@lean
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are at least as likely good as poor; fitted on the labels that aren't held out."""
    importable(spark)
    ratings = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), grade_of_labels().alias("grade"))
    return select_by_quality(docs, fit(docs, ratings.filter(~held_out("id")), grades=3), least_grade=1, least_tail=0.5)


@lean
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts (A-Z lower-cased): the one with the largest id."""
    importable(spark)
    return drop_exact_duplicates(docs, keep="largest")


@lean
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group: the one with the smallest id."""
    importable(spark)
    return drop_near_duplicates(docs, size=5, percent=85)


@lean
def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word passage of a benchmark item."""
    importable(spark)
    return decontaminated(docs, table(spark, sf_dir, "benchmark"), mode="drop", size=10)


@lean
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``token_ids`` and ``n_tokens``; ``round_trip`` says that the decoded ids give the text again."""
    importable(spark)
    return verified_tokens(docs, tokenizer_file())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("benchmark_free", benchmark_free), ("tokens", tokens)]

#: SQL can state neither the fitted classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    folder = work_folder(spark)
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, rows, sf_dir)

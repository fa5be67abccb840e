"""Token files: Parquet with one list of ids per document, laid out for selective reads.

Documents are range-partitioned by id, encoded with the tokenizers library
(each distinct word once per worker and kept), closed by an end id, and written
in ascending id order.  Ids are dictionary-encoded lists; small row groups and
pages with the format's column and page indexes let a reader take some
documents, or the metadata columns alone, without reading other ids.

Columns of the files: ``part`` (range partition), ``id``, ``start_in_part``,
``n_tokens`` (with the end id), ``tokens``.

Defined results: null text counts as empty and holds the end id only; null ids
come first; rows of one id follow each other in any order, each with its own
start; an empty table gives an empty file set and result; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparecast.llm.common import bounded_batches, offsets, per_batch, work_folder
from sparecast.llm.tokens import held_tokenizer, library_words

END_ID = 0
#: Distinct words that a worker keeps: more than elsewhere, since the library takes longer over new ones than over kept ones.
KEPT_WORDS = 1_000_000
#: Writer settings: row groups of 16 MB, pages of at most 2,000 documents or 256 KB, checksums in pages.
LAYOUT = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.page.write-checksum.enabled": "true",
}


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, parts: int) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    rows = rows.repartitionByRange(parts, F.asc_nulls_first("id")).sortWithinPartitions(F.asc_nulls_first("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        tokenizer = held_tokenizer(path, "library", library_words, KEPT_WORDS)
        end = np.array([END_ID], np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                ids = tokenizer.encode([t or "" for t in some.column(1).to_pylist()])
                lengths = np.fromiter((len(x) + 1 for x in ids), np.int64, len(ids))
                upto = np.cumsum(lengths)
                flat = np.concatenate([x for pair in ids for x in (pair, end)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, np.int32)), some.column(0), pa.array(start + upto - lengths), pa.array(lengths), lists],
                    ["part", "id", "start_in_part", "n_tokens", "tokens"])
                start += int(upto[-1])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"part int, id {kind}, start_in_part long, n_tokens long, tokens array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of ``docs`` to ``path``."""
    bounded_batches(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _encoded(docs, tokenizer_path, id_col, text_col, parts).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Documents with their ids; a filter on the metadata columns is pushed to row groups and pages."""
    rows = spark.read.parquet(path)
    return rows if where is None else rows.filter(where)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens`` of every document; no ids are read."""
    rows = spark.read.parquet(path).select("part", "id", "start_in_part", "n_tokens")
    return _with_start(rows).drop("part")


def _with_start(rows: DataFrame) -> DataFrame:
    before = offsets(rows.select("part", "n_tokens"), "part", "n_tokens", "before")  # one row per range partition
    return (rows.join(F.broadcast(before), "part").withColumn("start", F.col("start_in_part") + F.col("before"))
            .drop("start_in_part", "before"))


def checksums(rows: DataFrame) -> DataFrame:
    """``part, id, start_in_part, n_tokens, ids_crc32`` of rows of the files, from the ids as read."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(4)
        flat = lists.flatten().to_numpy().astype("<u4")
        sizes = np.array([0 if x is None else x for x in pc.list_value_length(lists).to_pylist()], np.int64)
        cut = np.concatenate([[0], np.cumsum(sizes)])
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], [*batch.schema.names[:4], "ids_crc32"])

    bounded_batches(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    ordered = rows.select("part", "id", "start_in_part", "n_tokens", "tokens")
    return per_batch(ordered, run, f"part int, id {kind}, start_in_part long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files to a work folder and return, from the files: id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = f"{work_folder(spark)}/tokens"
    write_tokens(docs, path, tokenizer_path, id_col, text_col)
    rows = read_tokens(spark, path)
    before = offsets(rows.select("part", "n_tokens"), "part", "n_tokens", "before")
    out = checksums(rows).join(F.broadcast(before), "part")
    return out.select(F.col("id").alias(id_col), (F.col("start_in_part") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

"""Exact duplicates by a tree merge of sorted digest runs.

Texts are equal when identical after lower-casing A-Z only.  Every row gives a
64-bit digest, which orders the runs, and the text's SHA-256, which verifies
each match.  Rows are dealt to ``RUNS`` runs; in each binomial round the runs
whose numbers agree above two bits exchange their rows by digest range, and one
multiway merge of the sorted rows keeps, for every verified text, the wanted
identifier (largest or smallest) and the number of copies.  A text holds one
row per run from the first merge on, so a group of copies of any size costs
``RUNS`` rows at most, and a merge holds a slice of the digest range only.  The
decisions go back down the tree: first to the leaf runs, then to the rows, so
that rows of a large group are spread over all runs there too.

Defined results: null text counts as empty; empty texts equal each other; a
null id is kept only if all ids of its group are null; repeated rows of the kept
id are all marked kept (``drop_exact_duplicates`` leaves one of them); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecast.llm.common import ascii_lower, only_rows, stored, work_folder

RUNS = 64
ROUND_BITS = 2


def text_proof(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def _same_as_before(rows: pa.Table) -> np.ndarray:
    """Whether each row has the run, the digest and the verified text of the row before it."""
    same = np.ones(rows.num_rows, bool)
    same[:1] = False
    proof = np.frombuffer(b"".join(rows.column("proof").to_pylist()), np.uint8).reshape(-1, 32)
    for key in (rows.column("run").to_numpy(), rows.column("digest").to_numpy()):
        same[1:] &= key[1:] == key[:-1]
    same[1:] &= (proof[1:] == proof[:-1]).all(1)
    return same


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text of a run from sorted rows; the last text of a batch waits for the next one."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        first = np.flatnonzero(~_same_as_before(rows))
        n = np.add.reduceat(rows.column("n").to_numpy(), first)
        merged = rows.take(pa.array(first)).set_column(rows.schema.get_field_index("n"), "n", pa.array(n))
        rest = merged.slice(merged.num_rows - 1)
        yield from merged.slice(0, merged.num_rows - 1).to_batches()
    if rest is not None:
        yield from rest.to_batches()


def _round(runs: DataFrame, bits: int, keep: str, partitions: int) -> DataFrame:
    best = F.desc_nulls_last("keep") if keep == "largest" else F.asc_nulls_last("keep")
    dealt = runs.withColumn("run", F.shiftright("run", bits)).repartitionByRange(partitions, "run", "digest")
    return dealt.sortWithinPartitions("run", "digest", "proof", best).mapInArrow(_merge, runs.schema)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep: 'largest' or 'smallest', not {keep!r}")
    spark = docs.sparkSession
    folder = work_folder(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), text_proof(F.col(text_col)).alias("proof"))
    run = F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(RUNS)).cast("int")
    rows = stored(rows.select("id", run.alias("run"), F.xxhash64("proof").alias("digest"), "proof"), f"{folder}/rows")
    leaves = rows.groupBy("run", "digest", "proof").agg(
        (F.max("id") if keep == "largest" else F.min("id")).alias("keep"), F.count(F.lit(1)).alias("n"))
    leaves = stored(leaves, f"{folder}/leaves")
    merged, left = leaves, RUNS
    while left > 1:
        merged = _round(merged, ROUND_BITS, keep, partitions)
        left = -(-left // (1 << ROUND_BITS))
    decided = merged.select("digest", "proof", F.col("keep").alias("keep_id"), F.col("n").alias("group_size"))
    back = leaves.select("run", "digest", "proof").join(decided, ["digest", "proof"])
    out = rows.join(back, ["run", "digest", "proof"])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("proof")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with exactly one row of every group of equal texts, all columns as they were."""
    kept = exact_duplicates(docs, id_col, text_col, keep).filter("kept")
    kept = kept.select(F.col(f"`{id_col}`").alias("id"), F.unhex("text_sha256").alias("key"))
    return only_rows(docs, kept, id_col, text_proof(F.col(f"`{text_col}`")))

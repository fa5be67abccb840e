"""Shards by bytes: a minimax contiguous partition of ordered groups of equal texts.

Groups stand in the order of their smallest id and are never parted.  The
smallest shard capacity for which greedy filling needs no more than the wanted
number of shards is found by binary search; the cuts are then placed within
that capacity, as near to an even split as the groups allow.

The group sizes stay distributed.  The driver holds at most a few times
``CELLS`` prefix sums: neighbouring groups are gathered in cells, and greedy
filling runs once on the cells' edges (a bound from above) and once as if every
byte of an undivided cell were an edge (a bound from below).  The cells in
which some cut may lie are divided again until both bounds meet, so the
capacity is exact.  Row ranks come from a range partitioning and one count per
partition, so a group of any number of copies is spread over many tasks.

Defined results: null text counts as no bytes; a group without any id comes
first; repeated rows get slots of their own in any order; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import offsets, stored, work_folder

CELLS = 1 << 16
ROW_OVERHEAD = 8


def _with_local_sums(df: DataFrame, sums: dict[str, str | None]) -> DataFrame:
    """Adds ``part`` and, for each name, the sum of a column (None: the rows) before the row in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base = TaskContext.get().partitionId(), dict.fromkeys(sums, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [pa.array(np.full(batch.num_rows, part, np.int32))]
            for name, column in sums.items():
                values = batch.column(column).to_numpy() if column else np.ones(batch.num_rows, np.int64)
                upto = np.cumsum(values)
                new.append(pa.array(base[name] + upto - values))
                base[name] += int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "part", *sums])

    new = [T.StructField("part", T.IntegerType()), *(T.StructField(name, T.LongType()) for name in sums)]
    return df.mapInArrow(run, T.StructType([*df.schema, *new]))


def _global_sums(df: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Turns the local sums (name to summed column) into sums over the whole table."""
    for name, column in sums.items():
        before = offsets(df, "part", column, "__before")
        df = df.join(F.broadcast(before), "part").withColumn(name, F.col(name) + F.col("__before")).drop("__before")
    return df


class Edges:
    """Some of the prefix sums of a sequence of sizes; cells between them are single groups or undivided."""

    def __init__(self, total: int) -> None:
        self.total = total
        self.edge = np.array([0, total], np.int64)
        self.single = np.array([False])

    def divide(self, starts: np.ndarray, counts: np.ndarray) -> None:
        """Add the starts of finer cells with their numbers of groups; replaced cells are given in whole."""
        edge = np.unique(np.concatenate([self.edge, starts]))
        single = np.zeros(len(edge) - 1, bool)
        single[np.searchsorted(edge, self.edge[:-1])] = self.single
        single[np.searchsorted(edge, starts)] = counts == 1
        self.edge, self.single = edge, single

    def below(self, x: np.ndarray) -> np.ndarray:
        """The largest known prefix sum up to ``x``."""
        return self.edge[np.searchsorted(self.edge, x, side="right") - 1]

    def at_most(self, x: int) -> int:
        """An upper bound of the largest prefix sum up to ``x``."""
        i = int(np.searchsorted(self.edge, x, side="right")) - 1
        return int(self.edge[i]) if i >= len(self.single) or self.single[i] else x

    def lower_cuts(self, capacity: int, shards: int) -> list[int]:
        out = [0]
        for _ in range(shards):
            out.append(int(self.below(min(out[-1] + capacity, self.total))))
        return out

    def upper_cuts(self, capacity: int, shards: int) -> list[int]:
        out = [0]
        for _ in range(shards):
            out.append(self.at_most(min(out[-1] + capacity, self.total)))
        return out

    def capacity_range(self, shards: int) -> tuple[int, int]:
        """``(too small, large enough)``; the smallest feasible capacity when they are neighbours."""

        def least(fits) -> int:
            lo, hi = 0, max(self.total, 1)
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (lo, mid) if fits(mid) else (mid, hi)
            return hi

        high = least(lambda c: self.lower_cuts(c, shards)[-1] >= self.total)
        low = least(lambda c: self.upper_cuts(c, shards)[-1] >= self.total)
        return low - 1, high

    def open_cells(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """The undivided cells in which a cut for a capacity above ``low`` and up to ``high`` may lie."""
        found = set()
        for a, b in zip(self.lower_cuts(low + 1, shards), self.upper_cuts(high, shards)):
            i, j = np.searchsorted(self.edge, (a, b), side="right") - 1
            found.update(k for k in range(max(i, 0), min(j, len(self.single) - 1) + 1) if not self.single[k])
        return [(int(self.edge[k]), int(self.edge[k + 1])) for k in sorted(found)]

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts of ``shards`` parts, none above the capacity, each as near to an even share of the rest as can be."""
        needed = [self.total]  # from the end: where shard j must start at the latest
        for _ in range(shards - 1):
            i = int(np.searchsorted(self.edge, needed[-1] - capacity, side="left"))
            needed.append(int(self.edge[min(i, len(self.edge) - 1)]))
        needed = needed[::-1]
        cuts = [0]
        for j in range(1, shards):
            start = cuts[-1]
            ideal = start + -(-(self.total - start) // (shards - j + 1))
            i = int(np.searchsorted(self.edge, ideal, side="left"))
            near = [int(self.edge[k]) for k in (i - 1, i) if 0 <= k < len(self.edge)]
            cut = min(near, key=lambda e: (abs(e - ideal), e))
            cuts.append(min(max(cut, needed[j - 1], start), int(self.below(min(start + capacity, self.total)))))
        return cuts


def _finer(groups: DataFrame, cells: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and group counts of finer cells inside the given ones: two for each of ``CELLS`` pieces at most.

    A piece gives the start of its first group and that of its last one, which
    is then a cell of its own; so every cell of several groups is divided, and
    groups that crowd beside a huge one are in a narrow cell the next time.
    """
    pieces = max(2, CELLS // len(cells))
    lo = np.array([c[0] for c in cells], np.int64)
    hi = np.array([c[1] for c in cells], np.int64)
    where = groups.sparkSession.sparkContext.broadcast((lo, hi, np.maximum(1, -(-(hi - lo) // pieces))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo_, hi_, step = where.value
        for batch in batches:
            start = batch.column(0).to_numpy()
            cell = np.maximum(np.searchsorted(lo_, start, side="right") - 1, 0)
            inside = (start >= lo_[cell]) & (start < hi_[cell])
            start, cell = start[inside], cell[inside]
            if len(start):
                piece = (start - lo_[cell]) // step[cell]
                first = np.flatnonzero(np.concatenate([[True], (np.diff(cell) != 0) | (np.diff(piece) != 0)]))
                upto = np.append(first[1:], len(start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[first]), pa.array(piece[first]), pa.array(start[first]), pa.array(start[upto - 1]), pa.array(upto - first)],
                    ["cell", "piece", "start", "last", "n"])

    found = groups.select("start").mapInArrow(run, "cell long, piece long, start long, last long, n long")
    rows = found.groupBy("cell", "piece").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n")).collect()
    return edges_of_pieces([r.start for r in rows], [r["last"] for r in rows], [r.n for r in rows])


def edges_of_pieces(first: list[int], last: list[int], n: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Cell starts and counts of pieces with ``n`` groups from ``first`` to ``last`` (starts)."""
    a, b, k = (np.array(x, np.int64) for x in (first, last, n))
    several = k > 1
    return np.concatenate([a, b[several]]), np.concatenate([np.where(several, k - 1, k), np.ones(several.sum(), np.int64)])


def smallest_capacity(groups: DataFrame, total: int, shards: int) -> tuple[int, Edges]:
    """The exact minimax capacity over ``groups`` (their ``start`` in bytes), and the edges known by then."""
    edges = Edges(total)
    while True:
        low, high = edges.capacity_range(shards)
        cells = edges.open_cells(low, high, shards)
        if (high - low <= 1 and len(edges.edge) > 2) or not cells or total == 0:
            return high, edges
        edges.divide(*_finer(groups, cells))


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` for every row (law ``bytes``)."""
    spark = docs.sparkSession
    folder = work_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(data) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
                       F.crc32(data).alias("crc"), F.unhex(F.sha2(data, 256)).alias("text"))
    rows = stored(rows, f"{folder}/rows")
    groups = rows.groupBy("text").agg(F.min("id").alias("first"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    groups = groups.repartitionByRange(parts, F.asc_nulls_first("first"), "text").sortWithinPartitions(F.asc_nulls_first("first"), "text")
    groups = _with_local_sums(groups.select("text", "bytes", "n"), {"start": "bytes", "row": "n"})
    groups = stored(_global_sums(stored(groups, f"{folder}/local_groups"), {"start": "bytes", "row": "n"}), f"{folder}/groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity, edges = smallest_capacity(groups, total, shards)
    cuts = edges.even_cuts(capacity, shards)
    shard = sum((F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts[1:]), F.lit(0)).cast("int")
    groups = groups.withColumn("shard", shard)
    bases = groups.groupBy("shard").agg(F.min("row").alias("base"))
    placed = groups.select("text", "row", "shard").join(F.broadcast(bases), "shard").select("text", "shard", "row", "base")
    ordered = rows.join(placed, "text").select("id", "size", "crc", "shard", "row", "base")
    ordered = ordered.repartitionByRange(parts, "row", F.asc_nulls_first("id")).sortWithinPartitions("row", F.asc_nulls_first("id"))
    ranked = stored(_with_local_sums(ordered, {"rank": None}).withColumn("one", F.lit(1).cast("long")), f"{folder}/ranked")
    ranked = _global_sums(ranked, {"rank": "one"})
    return ranked.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                         (F.col("rank") - F.col("base")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

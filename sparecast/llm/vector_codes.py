"""Compressed vectors: one codebook per part, fitted with adaptive bounds (Drake and Hamerly).

A vector's components become integers, ``floor(SCALE * x)``, and are cut into
``PARTS`` equal parts.  Each part position has a codebook of up to ``ENTRIES``
integer entries.  A round assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by the
componentwise floored mean of its parts.

Most distances are never computed.  Every part keeps, from round to round,

* its ``b`` closest entries, nearest first, with an upper bound of the distance
  to the first and a lower bound of the distance to each other one,
* one outer bound below the distances to all entries that aren't listed.

When entries move, the upper bound grows by its entry's move, each listed bound
shrinks by its own entry's move and the outer bound by the largest move.  A part
whose upper bound stays below all others keeps its entry without any distance.
Otherwise its own distance is computed; if that isn't enough, the listed
entries are compared and put in order again; if the outer bound fails too, all
entries are.  ``b`` starts at a quarter of the entries and is lowered to what nearly
all vectors (``COVER`` percent) needed in the last round, but not below an eighth.  Bounds are 32-bit floats rounded to the
safe side and only rule entries out: what they leave open is decided by integer
distances, so the assignment is that of a full search.

Each round is two passes over a table in the shared work folder: one moves the
bounds and writes the table anew, one sums the parts per entry (inside tasks
first).  Only the starting entries, the entries' sums and the counts of needed
ranks come to the driver, and only the codebooks go back.  A lost executor costs a part of one pass.

Defined results: rows with a null vector, or with null or non-finite components,
are dropped, and so are empty vectors and those whose length isn't that of the
first kept vector or no multiple of ``PARTS``; repeated rows are rows of their own, also
among the starting entries (ordered by id, null ids last, then by vector);
with fewer rows than entries the codebooks are smaller; integers beyond 2^60 are cut
to that, and distances and sums beyond a long are reported as the largest long;
labels may be null (they sum together); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparecast.llm.common import remove_folder, stored, work_folder

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LARGEST = 1 << 60
#: Integers below this give squared distances that a long holds for vectors of up to 2048 components.
NARROW = 1 << 25
MOST = (1 << 63) - 1
#: ``b`` is what this percentage of the vectors needs.
COVER = 95
#: Labels with more than this share of the rows are joined by a broadcast of so many rows at most.
HOT_LABELS = 1000
#: Relative slack of a bound, far above the rounding of 32-bit floats.
SLACK = 1e-6


def _finite(vector: Column) -> Column:
    x = lambda v: v.cast("double")
    return F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < float("inf")))


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, parts: int) -> DataFrame:
    """``id, label, x`` of the rows that count, ``x`` the integer components."""

    def whole(v: Column) -> Column:
        return F.greatest(F.least(F.floor(v.cast("double") * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("long")

    vector = F.col(f"`{vector_col}`")
    kept = rows.filter(vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0)).filter(_finite(vector))
    return kept.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.transform(vector, whole).alias("x"))


def first_entries(vectors: DataFrame, entries: int, parts: int) -> np.ndarray:
    """The starting codebooks, ``parts x entries x components``: the parts of the first vectors (fewer if there are fewer)."""
    order = [F.asc_nulls_last("id"), "x"]
    first = [r.x for r in vectors.orderBy(*order).limit(entries).select("x").collect()]
    if len({len(x) for x in first}) > 1:
        alike = vectors.filter(F.size("x") == len(first[0]))
        first = [r.x for r in alike.orderBy(*order).limit(entries).select("x").collect()]
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    return np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """Integers whose products can't overflow: as they are when all are small, else Python's."""
    small = all(not a.size or max(int(a.max()), -int(a.min())) < NARROW for a in arrays)
    return [a if small else a.astype(object) for a in arrays]


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every entry."""
    x, book = _exact(x, book)
    return np.stack([((x - e) ** 2).sum(1) for e in book], 1) if len(book) else np.zeros((len(x), 0), np.int64)


def _below(d: np.ndarray) -> np.ndarray:
    """Lower bounds of the roots of squared distances."""
    return (np.sqrt(d.astype(np.float64)) * (1 - SLACK)).astype(np.float32)


def _above(d: np.ndarray) -> np.ndarray:
    return (np.sqrt(d.astype(np.float64)) * (1 + SLACK)).astype(np.float32)


@dataclass
class Nearest:
    """Of each part: the listed entries, nearest first, and their bounds (upper, lower ones, outer)."""

    ids: np.ndarray  # n x b
    bounds: np.ndarray  # n x (b + 1)

    @classmethod
    def full(cls, x: np.ndarray, book: np.ndarray, b: int) -> Nearest:
        """By a search of all entries."""
        d = distances(x, book)
        order = np.argsort(d, axis=1, kind="stable")  # equal distances: the lower index first
        near = np.take_along_axis(d, order, 1)
        bounds = np.full((len(x), b + 1), np.inf, np.float32)
        bounds[:, 0] = _above(near[:, 0])
        bounds[:, 1:b] = _below(near[:, 1:b])
        if near.shape[1] > b:
            bounds[:, b] = _below(near[:, b])
        return cls(order[:, :b].astype(np.uint8), bounds)

    def fewer(self, b: int) -> Nearest:
        """The first ``b`` entries listed; the others go below the outer bound."""
        if b == self.ids.shape[1]:
            return self
        return Nearest(self.ids[:, :b], np.concatenate([self.bounds[:, :b], self.bounds[:, b:].min(1, keepdims=True)], 1))

    def moved(self, old: np.ndarray, new: np.ndarray) -> None:
        """Bounds after the entries moved from ``old`` to ``new``."""
        move = np.array([float(_above(distances(n[None], o[None])[0])[0]) for o, n in zip(old, new)])
        b = self.ids.shape[1]
        upper = (self.bounds[:, 0].astype(np.float64) + move[self.ids[:, 0]]) * (1 + SLACK)
        lower = self.bounds[:, 1:b] - move[self.ids[:, 1:]]
        outer = self.bounds[:, b] - move.max()
        slack = SLACK * (np.abs(self.bounds[:, 1:]) + move.max())
        rest = np.concatenate([lower, outer[:, None]], 1) - np.where(np.isfinite(slack), slack, 0)
        self.bounds = np.concatenate([upper[:, None], rest], 1).astype(np.float32)

    def settle(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Make the first listed entry the nearest one; returns how many listed entries each part needed."""
        b = self.ids.shape[1]
        need = np.ones(len(x), np.int64)
        open_ = np.flatnonzero(self.bounds[:, 0] >= self.bounds[:, 1:].min(1))
        own = self.ids[open_, 0]
        self.bounds[open_, 0] = _above(_each(x[open_], book, own[:, None])[:, 0])
        open_ = open_[self.bounds[open_, 0] >= self.bounds[open_, 1:].min(1)]
        far = self.bounds[open_, 0] >= self.bounds[open_, b]
        again, listed = open_[far], open_[~far]
        if len(listed):
            unsure = self.bounds[listed, :1] >= self.bounds[listed, 1:b]
            need[listed] = 1 + (unsure * np.arange(1, b)).max(1, initial=0)
            ids = np.sort(self.ids[listed], axis=1)
            d = _each(x[listed], book, ids)
            order = np.argsort(d, axis=1, kind="stable")
            near = np.take_along_axis(d, order, 1)  # the nearest is no farther than the own entry, so nearer than all unlisted
            self.ids[listed] = np.take_along_axis(ids, order, 1)
            self.bounds[listed, 0] = _above(near[:, 0])
            self.bounds[listed, 1:b] = _below(near[:, 1:])
        if len(again):
            found = Nearest.full(x[again], book, b)
            self.ids[again], self.bounds[again], need[again] = found.ids, found.bounds, b
        return need


def _each(x: np.ndarray, book: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``x`` to its own entries."""
    x, book = _exact(x, book)
    return ((x[:, None] - book[ids]) ** 2).sum(2)


def _parts(column: pa.Array, parts: int) -> np.ndarray:
    """``parts x rows x components`` of an Arrow list column."""
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), parts, -1).transpose(1, 0, 2)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list per row of a two-dimensional array."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).ravel(), kind))


def _state_schema(vectors: DataFrame) -> str:
    kind = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return f"id {kind['id']}, label {kind['label']}, x array<bigint>, near array<smallint>, bounds array<float>, need int"


def _assigned(state: DataFrame, old: np.ndarray | None, new: np.ndarray, listed: int, b: int, schema: str) -> DataFrame:
    """``state`` after the entries moved; with ``old`` None from nothing.  ``listed`` entries are listed before, ``b`` after."""
    parts = len(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _parts(batch.column(2), parts)
            if old is not None:
                ids = _parts(batch.column(3), parts).astype(np.uint8)
                bounds = _parts(batch.column(4), parts)
            nearest, need = [], np.ones(batch.num_rows, np.int64)
            for p in range(parts):
                if old is None:
                    nearest.append(Nearest.full(x[p], new[p], b))
                    continue
                one = Nearest(ids[p, :, :listed], bounds[p, :, : listed + 1]).fewer(b)
                one.moved(old[p], new[p])
                need = np.maximum(need, one.settle(x[p], new[p]))
                nearest.append(one)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 _lists(np.concatenate([n.ids for n in nearest], 1), pa.int16()),
                 _lists(np.concatenate([n.bounds for n in nearest], 1), pa.float32()), pa.array(need, pa.int32())],
                ["id", "label", "x", "near", "bounds", "need"])

    return state.mapInArrow(run, schema)


def _sums(state: DataFrame, parts: int, entries: int) -> tuple[dict[tuple[int, int], tuple[int, list[int]]], dict[int, int]]:
    """Count and component sums per (part, entry), and how many vectors needed how many listed entries.

    Every task sums its rows first and gives one row per sum; the counts of needs come as those of part -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, needed = np.zeros((parts, entries), np.int64), np.zeros(entries + 1, np.int64)
        total: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _parts(batch.column(0), parts)
            own = _parts(batch.column(1), parts)[:, :, 0]
            needed += np.bincount(batch.column(2).to_numpy(), minlength=entries + 1)
            if total is None:
                total = np.zeros((parts, entries, x.shape[2]), object)
            for p in range(parts):
                count[p] += np.bincount(own[p], minlength=entries)
                order = np.argsort(own[p], kind="stable")
                first = np.flatnonzero(np.diff(own[p][order], prepend=-1))
                values = x[p][order]
                if values.size and max(int(values.max()), -int(values.min())) >= 1 << 40:
                    values = values.astype(object)
                total[p, own[p][order][first]] += np.add.reduceat(values, first, axis=0).astype(object)
        if total is None:
            return
        rows = [(-1, k, 0, n, "0") for k, n in enumerate(needed.tolist()) if n]
        for p, e in zip(*(v.tolist() for v in np.nonzero(count))):
            rows += [(p, e, i, int(count[p, e]), str(v)) for i, v in enumerate(total[p, e].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()))], ["part", "entry", "at", "n", "total"])

    rows = state.select("x", "near", "need").mapInArrow(run, "part int, entry int, at int, n bigint, total string")
    rows = rows.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[tuple[int, int], tuple[int, dict[int, int]]] = {}
    for r in rows.collect():  # one row per component of an entry
        found.setdefault((r.part, r.entry), (r.n, {}))[1][r.at] = int(r.total)
    needs = {e: n for (p, e), (n, _) in found.items() if p < 0}
    return {k: (n, [v[i] for i in range(len(v))]) for k, (n, v) in found.items() if k[0] >= 0}, needs


def _listed(needs: dict[int, int], b: int, least: int) -> int:
    """How many entries to list from now on: enough for ``COVER`` percent of the vectors, never more than ``b``."""
    rows, below = sum(needs.values()), 0
    for need in sorted(needs):
        below += needs[need]
        if 100 * below >= COVER * rows:
            return max(least, min(b, need))
    return b


def _next_books(books: np.ndarray, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> np.ndarray:
    """Every used entry becomes the floored mean of its parts."""
    new = books.copy()
    for (p, e), (n, total) in sums.items():
        new[p, e] = [t // n for t in total]
    return new


def _errors(state: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of the final assignment."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, near = _parts(batch.column(2), parts), _parts(batch.column(3), parts)[:, :, 0]
            error = np.zeros(batch.num_rows, object)
            for p in range(parts):
                error += _each(x[p], books[p], near[p][:, None])[:, 0]
            codes = ["".join(f"{e:02x}" for e in row) for row in near.T.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes), pa.array([min(int(e), MOST) for e in error], pa.int64())],
                ["id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    return state.select("id", "label", "x", "near").mapInArrow(run, f"id {kind['id']}, label {kind['label']}, code string, error long")


def _with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` and ``label_error``.  A label of many rows is joined by broadcast, which holds ``HOT_LABELS`` rows
    at most; the others, each a small share of the rows, are joined by a shuffle on the label."""
    wide = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = rows.groupBy("label").agg(F.least(wide, F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"),
                                       F.count(F.lit(1)).alias("n"))
    share = F.col("n") * HOT_LABELS > rows.count()
    hot = totals.filter(share).select(F.col("label").alias("_hot"), F.col("label_error").alias("_hot_error"), F.lit(True).alias("_is_hot"))
    cold = totals.filter(~share).select(F.col("label").alias("_cold"), F.col("label_error").alias("_cold_error"))
    marked = rows.join(F.broadcast(hot), rows["label"].eqNullSafe(hot["_hot"]), "left")
    few = marked.filter("_is_hot is null").drop("_hot", "_hot_error", "_is_hot")
    few = few.join(cold, few["label"].eqNullSafe(cold["_cold"])).select(*rows.columns, F.col("_cold_error").alias("label_error"))
    return marked.filter("_is_hot").select(*rows.columns, F.col("_hot_error").alias("label_error")).unionByName(few)


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()


def fit_codes(vectors: DataFrame, folder: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The final state (``near`` holds each part's nearest entry first) and the codebooks of ``id, label, x`` rows."""
    spark = vectors.sparkSession
    books = first_entries(vectors, entries, parts)
    schema = _state_schema(vectors)
    if not books.shape[1]:
        return spark.createDataFrame([], schema), books
    state = vectors.filter(F.size("x") == parts * books.shape[2])
    b = min(books.shape[1], max(2, entries // 4))
    least, old, listed = min(b, max(2, entries // 8)), None, b
    for turn in range(rounds + 1):
        state = stored(_assigned(state, old, books, listed, b, schema), f"{folder}/state{turn}")
        if turn > 1:  # nothing reads the table before the last one any more
            remove_folder(spark, f"{folder}/state{turn - 2}")
        listed = b
        if turn < rounds:
            sums, needs = _sums(state, parts, books.shape[1])
            old, books = books, _next_books(books, sums)
            b = _listed(needs, b, least) if turn else b
    return state, books


def vector_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``id, code, error, label_error, codebooks_sha256`` of every row that counts."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    folder = work_folder(rows.sparkSession)
    state, books = fit_codes(integer_vectors(rows, id_col, vector_col, label_col, scale, parts), folder, parts, entries, rounds)
    coded = stored(_errors(state, books), f"{folder}/codes")
    for turn in range(max(0, rounds - 1), rounds + 1):
        remove_folder(rows.sparkSession, f"{folder}/state{turn}")
    out = _with_label_errors(coded)
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def codes_sql() -> str:
    """The registered query as DuckDB SQL: every round as a full search."""
    near = "list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, len(v) + 1)])"
    steps = []
    for turn in range(ROUNDS + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (SELECT r, p, v, min({{'d': {near}, 'e': e}}) AS b
  FROM (SELECT x.r, x.p, x.v, c.e, c.c FROM x JOIN c{turn} c ON x.p = c.p) GROUP BY r, p, v)""")
        if turn < ROUNDS:
            steps.append(f"""s{turn} AS (SELECT p, e, i, sum(v[i]) AS s, count(*) AS n
  FROM (SELECT p, b.e AS e, v, unnest(range(1, len(v) + 1)) AS i FROM a{turn}) GROUP BY p, e, i),
m{turn} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{turn} GROUP BY p, e),
c{turn + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM c{turn} o LEFT JOIN m{turn} m ON o.p = m.p AND o.e = m.e)""")
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                  [CAST(floor({SCALE} * CAST(y AS DOUBLE)) AS BIGINT) for y in embedding] AS w
           FROM embeddings WHERE len(embedding) > 0 AND len([y for y in embedding if y IS NULL OR isnan(y) OR isinf(y)]) = 0),
x AS MATERIALIZED (SELECT r, p, w[p * len(w) // {PARTS} + 1:(p + 1) * len(w) // {PARTS}] AS v FROM (SELECT r, w, unnest(range({PARTS})) AS p FROM k)),
c0 AS (SELECT p, r - 1 AS e, v AS c FROM x WHERE r <= {ENTRIES}),
{(',' + chr(10)).join(steps)},
f AS (SELECT r, string_agg(printf('%02x', b.e), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM k JOIN f ON k.r = f.r, h
"""

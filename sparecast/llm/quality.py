"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades, with one
ordered threshold below each grade but the lowest:
``P(grade >= k) = sigmoid(w.x - threshold_k)``.  The expected grade is the sum
of these tail probabilities; documents are selected by one of them.

Features of a text, hashed into ``DIM`` places: its byte trigrams (square roots
of their shares), and indicators of its length, of the share of its byte
8-grams that are new to it, of the shares of capitals and signs, and of the
words that repeat the word before them, each in steps.  The whole text is read.

The model is fitted on a bounded sample of the rated rows, at most
``sample_rows`` chosen by a hash of the id; only their feature rows (sample
size times ``DIM`` numbers) reach the driver.  The thresholds start at the
grades' smoothed shares and stay ordered by construction.

Defined results: null text counts as empty; rows with a null id or a null grade
are not fitted; ids rated twice count twice; with no rated rows every grade is
equally likely and everything is selected; an empty table gives an empty
result; ``select_by_quality`` keeps all columns as they were.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import per_batch, utf8_texts
from sparecast.llm.words import SPACED, spans, substring_hashes

DIM = 4096
SAMPLE_ROWS = 4000
STEPS, RATE, DECAY = 400, 0.05, 1e-5
_STEP_BITS = 32  # places kept for each kind of indicator
_KINDS = 5
_GRAMS = DIM - _KINDS * _STEP_BITS
_BLOCK = 1 << 18

_CAPITAL = np.array([0x41 <= b <= 0x5A for b in range(256)])
_SIGN = np.array([b > 0x20 and not chr(b).isalnum() and b < 0x80 for b in range(256)])


def features(text: bytes) -> np.ndarray:
    """The feature row of a text; square norm about 1 plus the indicators'."""
    out = np.zeros(DIM, np.float32)
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    grams = np.zeros(_GRAMS, np.int64)
    seen = np.zeros(1 << 16, bool)
    new = capitals = signs = 0
    for at in range(0, n, _BLOCK):
        chunk = data[at : at + _BLOCK + 7].astype(np.uint64)
        capitals += int(_CAPITAL[data[at : at + _BLOCK]].sum())
        signs += int(_SIGN[data[at : at + _BLOCK]].sum())
        if len(chunk) >= 3:
            three = chunk[:-2] | chunk[1:-1] << np.uint64(8) | chunk[2:] << np.uint64(16)
            place = (three * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(_GRAMS)
            grams += np.bincount(place[:_BLOCK].astype(np.int64), minlength=_GRAMS)
            if len(three) >= 6:
                eight = (three[:-5] | three[3:-2] << np.uint64(24) | three[5:] << np.uint64(40)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)
                before = int(seen.sum())
                seen[eight[:_BLOCK].astype(np.int64)] = True
                new += int(seen.sum()) - before
    total = int(grams.sum())
    if total:
        out[:_GRAMS] = np.sqrt(grams / total)
    expected = (1 << 16) * -np.expm1(-max(n - 7, 0) / (1 << 16))  # of the places, if all 8-grams were new
    steps = (min(int(np.log2(n + 1)), _STEP_BITS - 1),
             int(min(1.0, new / expected) * (_STEP_BITS - 1)) if expected >= 1 else 0,
             int(capitals / max(n, 1) * (_STEP_BITS - 1)), int(signs / max(n, 1) * (_STEP_BITS - 1)),
             int(_repeated(data) * (_STEP_BITS - 1)))
    for kind, step in enumerate(steps):
        out[_GRAMS + kind * _STEP_BITS + step] = 0.3
    return out


def _repeated(data: np.ndarray) -> float:
    """The share of words that are the same as the word before them."""
    starts, ends = spans(data, SPACED)
    if len(starts) < 2:
        return 0.0
    words = substring_hashes(data, starts, ends)
    return float((words[1:] == words[:-1]).mean())


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one below each grade but the lowest

    def tails(self, x: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1 .. grades - 1."""
        return 1 / (1 + np.exp(-(x @ self.weights - self.thresholds)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, steps: int = STEPS) -> OrdinalModel:
    """Maximum likelihood with a small ridge, by full-batch gradient steps (Adam)."""
    counts = np.bincount(grade, minlength=grades) + 1.0
    tail = 1 - np.cumsum(counts)[:-1] / counts.sum()
    thresholds = -np.log(tail / (1 - tail))
    if not len(x):
        even = 1 - np.arange(1, grades) / grades
        return OrdinalModel(np.zeros(DIM), -np.log(even / (1 - even)))
    # the gaps between thresholds are kept positive by their logarithms
    p = np.concatenate([np.zeros(x.shape[1]), thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    rows = np.arange(len(x))
    dim = x.shape[1]
    for step in range(1, steps + 1):
        gaps = np.exp(p[dim + 1 :])
        th = p[dim] + np.concatenate([[0], np.cumsum(gaps)])
        at_least = 1 / (1 + np.exp(-np.clip((x @ p[:dim].astype(np.float32))[:, None] - th, -30, 30)))
        edges = np.concatenate([np.ones((len(x), 1)), at_least, np.zeros((len(x), 1))], axis=1)
        slope = edges * (1 - edges)
        likely = np.maximum(edges[rows, grade] - edges[rows, grade + 1], 1e-12)
        by_score = (slope[rows, grade] - slope[rows, grade + 1]) / likely / len(x)
        by_th = np.zeros(grades + 1)
        np.add.at(by_th, grade, -slope[rows, grade] / likely / len(x))
        np.add.at(by_th, grade + 1, slope[rows, grade + 1] / likely / len(x))
        by_th = by_th[1:-1]
        rising = np.concatenate([x.T @ by_score.astype(np.float32), [by_th.sum()], np.cumsum(by_th[::-1])[::-1][1:] * gaps])
        rising[:dim] -= DECAY * p[:dim]
        m = 0.9 * m + 0.1 * rising
        v = 0.999 * v + 0.001 * rising**2
        p = p + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(p[:dim], p[dim] + np.concatenate([[0], np.cumsum(np.exp(p[dim + 1 :]))]))


def grade_of_labels() -> Column:
    """Grades of the ``labels`` table: 0 poor, 1 good but toxic, 2 good."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)


def held_out(id_col: str) -> Column:
    """The fifth of the ids that no model is fitted on."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on ``ratings`` (``id``, ``grade``) joined with the texts of ``docs``."""
    rated = ratings.filter("id IS NOT NULL AND grade IS NOT NULL")
    sample = rated.orderBy(F.xxhash64("id"), "id", "grade").limit(sample_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    rows = texts.join(F.broadcast(sample), "id").select("id", F.col("grade").cast("int").alias("grade"), "t")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [features(t).astype(np.float16).tobytes() for t in utf8_texts(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], ["id", "grade", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    got = per_batch(rows, run, f"id {kind}, grade int, x binary").orderBy(F.xxhash64("id"), "id", "grade", "x").limit(sample_rows).collect()
    x = np.frombuffer(b"".join(r.x for r in got), np.float16).reshape(-1, DIM).astype(np.float32)
    return fit_ordinal(x, np.array([r.grade for r in got], np.int64), grades)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", least_grade: int = 1,
          least_tail: float = 0.5) -> DataFrame:
    """``id, expected_grade, tails, selected`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tails = [shared.value.tails(features(t)) for t in utf8_texts(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([float(t.sum()) for t in tails]), pa.array([t.tolist() for t in tails], pa.list_(pa.float64())),
             pa.array([bool(t[least_grade - 1] >= least_tail) for t in tails])], [id_col, "expected_grade", "tails", "selected"])

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    schema = T.StructType([rows.schema[0], *T.StructType.fromDDL("expected_grade double, tails array<double>, selected boolean")])
    return per_batch(rows, run, schema)


def select_by_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least_grade: int = 1,
                      least_tail: float = 0.5) -> DataFrame:
    """The rows whose probability of at least ``least_grade`` reaches ``least_tail``, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [bool(shared.value.tails(features(t))[least_grade - 1] >= least_tail) for t in utf8_texts(batch.column(place))]
        return batch.filter(pa.array(keep, pa.bool_()))

    return per_batch(docs, run, docs.schema)


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on the labelled rows that aren't held out, score every row."""
    ratings = labels.select(F.col("doc_id").alias("id"), grade_of_labels().alias("grade")).filter(~held_out("id"))
    model = fit(docs, ratings, 3, id_col, text_col)
    rows = score(docs, model, id_col, text_col)
    return rows.select(id_col, held_out(id_col).alias("held_out"), "expected_grade", F.col("tails")[0].alias("p_good"),
                       F.col("tails")[1].alias("p_best"), "selected")

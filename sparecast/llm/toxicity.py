"""Toxicity by compression distance: windows compressed with an ordinary and a toxic zstandard dictionary.

Texts are lower-cased (A-Z), their white space is made single blanks, and they
are cut at blanks into windows of about ``WINDOW`` bytes.  The ordinary
dictionary is trained on windows of ordinary text.  The toxic one is trained on
what toxic text has and ordinary text hardly has: runs of byte 6-grams that are
``LEAST_RATIO`` times as frequent in distinct toxic contexts (a word with its
two neighbours, so copies of a text count once).  Each window is compressed
with the ordinary dictionary, and with the toxic one laid before it; the bytes
saved by the toxic one are the window's distance.  How many windows save how
much, over the whole text, gives the score through a logistic curve that is
calibrated on labelled texts.

Both steps fit on bounded samples chosen by hash: at most ``PIECES`` pieces of
``PIECE_BYTES`` per class for the dictionaries, at most ``SAMPLE_ROWS``
labelled texts for the calibration.  Labels whose id is held out are never read.

Defined results: null text counts as empty, which has no windows and gets the
score of a text without any saving; labels with a null id or null class are
not fitted; without labels of both classes every score is the smoothed share of
toxic labels (one half if there are none); repeated rows each get their score;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import per_batch, utf8_texts
from sparecast.llm.words import LOWER, SPACED, Words, mix, passes

WINDOW = 64
LEVEL = 9
ORDINARY_BYTES, TOXIC_BYTES = 8192, 1024
GRAM, LEAST_CONTEXTS, LEAST_RATIO = 6, 8, 8
PIECES, PIECE_BYTES = 5000, 4096
SAMPLE_ROWS = 8000
LOW, HIGH = -3, 9  # savings are counted in this range of bytes, the ends hold the rest

_U = np.uint64


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The normalised text, cut at the first blank after each ``size`` bytes (or at twice the size)."""
    text = b" ".join(text.translate(LOWER).split())
    out, at = [], 0
    while at < len(text):
        end = at + size
        if end < len(text):
            blank = text.find(b" ", end, at + 2 * size)
            end = blank if blank >= 0 else at + 2 * size
        out.append(text[at:end])
        at = end
    return out


def _context_words(texts: list[bytes]) -> list[bytes]:
    """The word of every distinct context (word before, word, word after), framed by blanks."""
    seen: set[int] = set()
    out = []
    for _, run in passes(texts):
        w = Words(run, SPACED)
        same = w.text[1:] == w.text[:-1]
        before = np.concatenate([np.zeros(min(1, len(w.hashes)), np.uint64), np.where(same, w.hashes[:-1], _U(0))])
        after = np.concatenate([np.where(same, w.hashes[1:], _U(0)), np.zeros(min(1, len(w.hashes)), np.uint64)])
        keys = mix(mix(before + _U(1)) + mix(w.hashes + _U(2)) * _U(3) + mix(after + _U(3)) * _U(5))
        distinct, first = np.unique(keys, return_index=True)
        for k, i in zip(distinct.tolist(), first.tolist()):
            if k not in seen:
                seen.add(k)
                out.append(b" " + w.data[w.starts[i] : w.ends[i]] + b" ")
    return out


def _grams(words: list[bytes]) -> np.ndarray:
    """The 6-grams inside the words, as integers."""
    data = np.frombuffer(b"\n".join(words), np.uint8)
    n = max(0, len(data) - GRAM + 1)
    value, inside = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(GRAM):
        value |= data[k : n + k].astype(np.uint64) << _U(8 * (GRAM - 1 - k))
        inside &= data[k : n + k] != 10
    return value[inside]


def marked_grams(toxic: list[bytes], ordinary: list[bytes]) -> set[int]:
    """6-grams that many toxic contexts have and ordinary ones hardly have."""
    ours, others = _grams(_context_words(toxic)), _grams(_context_words(ordinary))
    gram, count = np.unique(ours, return_counts=True)
    gram0, count0 = np.unique(others, return_counts=True)
    if not len(gram) or not len(gram0):
        return set()
    at = np.minimum(np.searchsorted(gram0, gram), len(gram0) - 1)
    elsewhere = np.where(gram0[at] == gram, count0[at], 0)
    marked = (count >= LEAST_CONTEXTS) & (count * float(len(others)) >= LEAST_RATIO * (elsewhere + 1) * float(len(ours)))
    return set(gram[marked].tolist())


def residue(text: bytes, marked: set[int]) -> bytes:
    """The parts of the text's words that marked 6-grams cover."""
    out = []
    for word in text.translate(LOWER).split():
        word = b" " + word + b" "
        covered = bytearray(len(word))
        for i in range(len(word) - GRAM + 1):
            if int.from_bytes(word[i : i + GRAM], "big") in marked:
                covered[i : i + GRAM] = b"\x01" * GRAM
        if any(covered):
            out.append(bytes(c for c, on in zip(word, covered) if on).strip())
    return b" " + b" ".join(out) + b" " if out else b""


def _trained(samples: list[bytes], size: int, segment: int, gram: int) -> bytes:
    """The content of a trained dictionary; where there is too little to train on, the end of the samples."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=gram, level=LEVEL).as_bytes()[200:]
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    @staticmethod
    def train(toxic: list[bytes], ordinary: list[bytes]) -> Dictionaries:
        marked = marked_grams(toxic, ordinary)
        left = [r for r in (residue(t, marked) for t in toxic) if len(r) > 7]
        plain = [w for t in ordinary for w in windows(t, 2 * WINDOW)]
        return Dictionaries(_trained(plain, ORDINARY_BYTES, 32, 6), _trained(left, TOXIC_BYTES, 64, 8))


class Distances:
    """Window savings of texts under a pair of dictionaries."""

    def __init__(self, pair: Dictionaries) -> None:
        self.plain, self.both = (self._compressor(d) for d in (pair.ordinary, pair.toxic + pair.ordinary))

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)

    def features(self, text: bytes) -> np.ndarray:
        """Shares and logarithmic counts of windows by bytes saved, and the largest and mean savings."""
        plain, both = self.plain.compress, self.both.compress
        saved = np.fromiter((len(plain(w)) - len(both(w)) for w in windows(text)), np.int64)
        if not len(saved):
            saved = np.zeros(1, np.int64)
        counts = np.bincount(np.clip(saved, LOW, HIGH) - LOW, minlength=HIGH - LOW + 1)
        top = np.sort(saved)[::-1]
        return np.concatenate([counts / len(saved), np.log1p(counts),
                               [top[0], saved.mean(), top[:3].mean(), top[:10].mean(), np.log1p(len(saved))]])


@dataclass(frozen=True)
class Calibration:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, steps: int = 600) -> Calibration:
        """Logistic regression by full-batch gradient steps (Adam) with a small ridge."""
        share = (y.sum() + 1) / (len(y) + 2)
        mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
        scale = x.std(0) + 1e-6 if len(x) else np.ones(x.shape[1])
        w = np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
        if not 0 < y.sum() < len(y):
            return Calibration(mean, scale, w)
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        m, v = np.zeros_like(w), np.zeros_like(w)
        for k in range(1, steps + 1):
            rising = z.T @ (y - 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))) / len(y) - 1e-3 * np.append(w[:-1], 0)
            m, v = 0.9 * m + 0.1 * rising, 0.999 * v + 0.001 * rising**2
            w = w + 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        return Calibration(mean, scale, w)


def held_out(column: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, rated: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
        pieces: int = PIECES) -> tuple[Dictionaries, Calibration]:
    """Train on ``rated`` (``id``, ``toxic`` 0 or 1) and the texts of ``docs``."""
    rated = rated.filter("id IS NOT NULL AND toxic IN (0, 1)").select("id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))

    def chosen(rows: DataFrame, n: int) -> DataFrame:
        return rows.orderBy(F.xxhash64("id"), "id").limit(n)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, out = batch.column(0).to_pylist(), []
        for i, toxic, text in zip(ids, batch.column(1).to_pylist(), utf8_texts(batch.column(2))):
            out += [(toxic, str(i), n, p) for n, p in enumerate(windows(text, PIECE_BYTES // 2))]
        cols = list(zip(*out)) or [[]] * 4
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["toxic", "id", "n", "piece"])

    per_class = F.broadcast(chosen(rated.filter("toxic = 1"), pieces).union(chosen(rated.filter("toxic = 0"), pieces)))
    cuts = per_batch(texts.join(per_class, "id").select("id", "toxic", "t"), cut, "toxic int, id string, n long, piece binary")
    samples: dict[int, list[bytes]] = {}
    for kind in (0, 1):  # at most ``pieces`` times PIECE_BYTES each
        rows = cuts.filter(F.col("toxic") == kind).orderBy(F.xxhash64("id", "n"), "id", "n", "piece").limit(pieces)
        samples[kind] = [bytes(r.piece) for r in rows.select("piece").collect()]
    pair = Dictionaries.train(samples[1], samples[0])

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        d = Distances(pair)
        x = [d.features(t).tolist() for t in utf8_texts(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["id", "toxic", "x"])

    kind = texts.schema["id"].dataType.simpleString()
    some = texts.join(F.broadcast(chosen(rated, sample_rows)), "id").select("id", "toxic", "t")
    measured = per_batch(some, measure, f"id {kind}, toxic int, x array<double>")
    rows = measured.orderBy(F.xxhash64("id"), "id", "toxic", "x").limit(sample_rows).collect()
    width = len(Distances(pair).features(b""))
    x = np.array([r.x for r in rows], float).reshape(-1, width)
    return pair, Calibration.fit(x, np.array([r.toxic for r in rows], float))


def score(docs: DataFrame, pair: Dictionaries, curve: Calibration, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """``id, score, predicted`` for every row of ``docs``, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast((pair, curve))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        dictionaries, calibration = shared.value
        d = Distances(dictionaries)
        x = np.array([d.features(t) for t in utf8_texts(batch.column(1))])
        s = calibration.score(x)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [id_col, "score", "predicted"])

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    schema = T.StructType([rows.schema[0], *T.StructType.fromDDL("score double, predicted int")])
    return per_batch(rows, run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted``: fitted on the labels that aren't held out."""
    rated = labels.select(F.col("doc_id").alias("id"), "toxic").filter(~held_out("id"))
    pair, curve = fit(docs, rated, id_col, text_col)
    rows = score(docs, pair, curve, id_col, text_col)
    return rows.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")

"""Benchmark decontamination: a broadcast hash set of the test windows against all training windows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.  An item's windows are its runs of ten words, or all its words if
there are fewer.  Every document window is looked up by hash and each hit is
verified word for word; the words inside verified windows are hit.

The hash set is broadcast only while the windows' text stays below
``max_broadcast_bytes``.  Beyond that, the document windows that pass a bitmap
of fixed size are joined with the benchmark's windows in a shuffle instead,
and their hits with the documents by the text's SHA-256.

Defined results: a null or empty text has no words and no hits; a null item
text has no windows; a null item_id hits words but is not listed as an item;
items with one id count once; repeated document rows each get their own
result; an empty benchmark hits nothing; extra columns are ignored (kept by
``decontaminated``).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparecast.llm.common import per_batch, stored, utf8_texts, work_folder
from sparecast.llm.words import ALNUM, Words, passes, window_hashes

WINDOW = 10
MAX_BROADCAST_BYTES = 32 << 20
BITMAP_BITS = 24

_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``item, size, hash, words``: the distinct windows of every item."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, out = batch.column(0).to_pylist(), []
        for at, texts in passes(utf8_texts(batch.column(1))):
            w = Words(texts, ALNUM)
            for i in range(len(texts)):
                own = min(size, int(w.counts[i]))
                if own:
                    lo, hi = int(w.bounds[i]), int(w.bounds[i + 1])
                    hashes = window_hashes(w.hashes[lo:hi], own)
                    out += [(items[at + i], own, h, w.run(lo + k, own)) for k, h in enumerate(hashes.view(np.int64).tolist())]
        cols = list(zip(*out)) or [[], [], [], []]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["item", "size", "hash", "words"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("t"))
    return per_batch(rows, run, "item string, size int, hash long, words binary").distinct()


class WindowSet:
    """The windows of the benchmark by size: sorted hashes, a bitmap before them, words and items behind them."""

    def __init__(self, rows: list[tuple]) -> None:
        grouped: dict[int, dict[int, dict[bytes, list[str]]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(list)))
        for item, size, h, words in rows:
            grouped[size][h & ((1 << 64) - 1)][bytes(words)].append(item)
        self.sizes = {}
        for size, by_hash in sorted(grouped.items()):
            hashes = np.array(sorted(by_hash), np.uint64)
            near = np.zeros(1 << 20, bool)
            near[hashes >> np.uint64(44)] = True
            self.sizes[size] = (hashes, near, {h: dict(w) for h, w in by_hash.items()})

    def hits(self, w: Words) -> list[tuple[int, int, list[str]]]:
        """``(first word, size, items)`` of every verified window of the texts."""
        out = []
        for size, (hashes, near, exact) in self.sizes.items():
            first, h = w.windows(size)
            some = near[h >> np.uint64(44)]
            first, h = first[some], h[some]
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            some = hashes[at] == h
            for f, x in zip(first[some].tolist(), h[some].tolist()):
                items = exact[x].get(w.run(f, size))
                if items is not None:
                    out.append((f, size, items))
        return out


def _covered(w: Words, hits: list[tuple[int, int, list[str]]]) -> np.ndarray:
    step = np.zeros(len(w.starts) + 1, np.int64)
    for first, size, _ in hits:
        step[first] += 1
        step[first + size] -= 1
    return np.cumsum(step)[:-1] > 0


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _broadcast_result(docs: DataFrame, text_col: str, rows: list[tuple]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    held: list[WindowSet] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(WindowSet(shared.value))
        n_words, n_hit, n_items, digests = [], [], [], []
        for _, texts in passes(utf8_texts(batch.column(batch.num_columns - 1))):
            w = Words(texts, ALNUM)
            hits = held[0].hits(w)
            items: list[set[str]] = [set() for _ in texts]
            for first, _, names in hits:
                items[w.text[first]].update(x for x in names if x is not None)
            n_words += w.counts.tolist()
            n_hit += np.bincount(w.text[_covered(w, hits)], minlength=len(texts)).tolist()
            n_items += map(len, items)
            digests += map(_digest, items)
        found = pa.array(n_hit, pa.int64())
        new = [pa.array(n_words, pa.int64()), found, pa.array(n_items, pa.int64()), pa.array(digests, pa.string()), pa.array(x > 0 for x in n_hit)]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], schema=_arrow(schema))

    kept = [f for f in docs.schema if f.name != text_col]
    schema = T.StructType([*kept, *T.StructType.fromDDL(_RESULT)])
    return per_batch(docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`")), run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _key(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)


def _joined_hits(docs: DataFrame, text_col: str, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, n_words`` of every distinct text and ``key, first, size, item`` of every verified hit.

    A bitmap of fixed size and a shuffle join, for a benchmark of any size; the key is the text's SHA-256.
    """
    folder = work_folder(docs.sparkSession)
    windows = stored(windows, f"{folder}/windows")
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_BITS).cast("int")
    bits = np.zeros(1 << BITMAP_BITS, bool)
    sizes = [r[0] for r in windows.select("size").distinct().orderBy("size").collect()]  # WINDOW values at most
    slots = windows.select((slot / 32).cast("int").alias("w"), (slot % 32).alias("b")).groupBy("w").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b"))).alias("m"))
    for r in slots.toLocalIterator():  # 2 ** BITMAP_BITS / 32 rows at most, whatever the input
        for b in range(32):
            bits[r.w * 32 + b] = r.m >> b & 1
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    held: list[np.ndarray] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(np.unpackbits(shared.value).view(bool))
        out = []
        keys = batch.column(0).to_pylist()
        for at, texts in passes(utf8_texts(batch.column(1))):
            w = Words(texts, ALNUM)
            out += [(keys[at + i], int(n), -1, 0, 0, b"") for i, n in enumerate(w.counts)]
            for size in sizes:
                first, h = w.windows(size)
                some = held[0][h >> np.uint64(64 - BITMAP_BITS)]
                first, h = first[some], h[some]
                place = first - w.bounds[w.text[first]]
                out += [(keys[at + t], 0, p, size, x, w.run(f, size)) for f, t, p, x in
                        zip(first.tolist(), w.text[first].tolist(), place.tolist(), h.view(np.int64).tolist())]
        cols = list(zip(*out)) or [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["key", "n_words", "first", "size", "hash", "words"])

    texts = docs.select(_key(text_col).alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t")).distinct()
    seen = stored(per_batch(texts, run, "key string, n_words long, first long, size int, hash long, words binary"), f"{folder}/seen")
    hits = seen.filter("first >= 0").drop("n_words").join(windows, ["size", "hash", "words"])
    return seen.filter("first < 0").select("key", "n_words"), hits


def _hit_words(hits: DataFrame) -> DataFrame:
    """``key, p``: the places of the words inside verified windows, each once."""
    return hits.select("key", F.explode(F.sequence("first", F.col("first") + F.col("size") - 1)).alias("p")).distinct()


def _joined_result(docs: DataFrame, id_col: str, text_col: str, windows: DataFrame) -> DataFrame:
    """The same rows as ``_broadcast_result``, for a benchmark of any size."""
    texts, hits = _joined_hits(docs, text_col, windows)
    hit = _hit_words(hits).groupBy("key").agg(F.count("*").alias("n_hit"))
    items = hits.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per_text = (texts.join(hit, "key", "left").join(items, "key", "left")
                .select("key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256")))
    out = docs.select(F.col(f"`{id_col}`").alias("id"), _key(text_col).alias("key")).join(per_text, "key")
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``."""
    windows = benchmark_windows(benchmark, item_col, item_text_col, size)
    rows = _if_small(windows, max_broadcast_bytes)
    if rows is None:
        return _joined_result(docs, id_col, text_col, windows)
    return _broadcast_result(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), text_col, rows)


def _if_small(windows: DataFrame, limit: int) -> list[tuple] | None:
    """The windows, if their text and keys stay below ``limit`` bytes."""
    total = windows.agg(F.sum(F.length("words") + F.coalesce(F.length("item"), F.lit(0)) + 16)).first()[0] or 0
    return [tuple(r) for r in windows.collect()] if total <= limit else None


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", mode: str = "drop",
                   item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW,
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``docs`` without its hits, all columns as they were.

    ``mode="drop"`` removes every document with a hit; ``mode="cut"`` removes
    the hit words and what stands between them from the text and sets
    ``n_chars``, where there is such a column, to the new length.
    """
    if mode not in ("drop", "cut"):
        raise ValueError(f"mode: 'drop' or 'cut', not {mode!r}")
    windows = benchmark_windows(benchmark, item_col, item_text_col, size)
    rows = _if_small(windows, max_broadcast_bytes)
    if rows is None:
        return _joined_without(docs, text_col, windows, mode)
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    held: list[WindowSet] = []
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(WindowSet(shared.value))
        keep, cut = [], {}
        for at, texts in passes(utf8_texts(batch.column(place))):
            w = Words(texts, ALNUM)
            inside = _covered(w, held[0].hits(w))
            keep += (np.bincount(w.text[inside], minlength=len(texts)) == 0).tolist()
            cut.update((at + i, t) for i, t in _cut(w, texts, inside))
        return batch.filter(pa.array(keep, pa.bool_())) if mode == "drop" else _replaced(batch, place, cut)

    return per_batch(docs, run, docs.schema)


def _joined_without(docs: DataFrame, text_col: str, windows: DataFrame, mode: str) -> DataFrame:
    """The same rows for a benchmark of any size: hits by the text's SHA-256, joined with the documents."""
    _, hits = _joined_hits(docs, text_col, windows)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("row"), _key(text_col).alias("key"))
    if mode == "drop":
        return keyed.join(hits.select("key").distinct(), "key", "left_anti").select("row.*")
    places = _hit_words(hits).groupBy("key").agg(F.collect_list("p").alias("places"))
    rows = keyed.join(places, "key", "left").select("row.*", F.col("places").alias("__places"))
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at_words, cut = batch.column(batch.num_columns - 1), {}
        for at, texts in passes(utf8_texts(batch.column(place))):
            w = Words(texts, ALNUM)
            inside = np.zeros(len(w.starts), bool)
            for i in range(len(texts)):
                if (p := at_words[at + i].as_py()) is not None:
                    inside[w.bounds[i] + np.array(p, np.int64)] = True
            cut.update((at + i, t) for i, t in _cut(w, texts, inside))
        docs_only = pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1]))
        return _replaced(docs_only, place, cut)

    return per_batch(rows, run, docs.schema)


def _cut(w: Words, texts: list[bytes], inside: np.ndarray) -> list[tuple[int, str]]:
    """``(number of the text, text without its hit words)`` of the texts with a hit."""
    base = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    out = []
    for i in np.unique(w.text[inside]).tolist():
        lo, hi = w.bounds[i], w.bounds[i + 1]
        out.append((i, _without(texts[i], w.starts[lo:hi] - base[i], w.ends[lo:hi] - base[i], inside[lo:hi])))
    return out


def _replaced(batch: pa.RecordBatch, place: int, cut: dict[int, str]) -> pa.RecordBatch:
    """The batch with the cut texts and, where there is such a column, their ``n_chars``."""
    texts = batch.column(place).to_pylist()
    for i, t in cut.items():
        texts[i] = t
    columns = list(batch.columns)
    columns[place] = pa.array(texts, batch.schema.field(place).type)
    if "n_chars" in batch.schema.names:
        at = batch.schema.names.index("n_chars")
        lengths = columns[at].to_pylist()
        for i, t in cut.items():
            lengths[i] = len(t)
        columns[at] = pa.array(lengths, batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _without(text: bytes, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> str:
    """The text without its hit words and what stands between two of them."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    kept, at = [], 0
    for lo, hi in zip(edge[::2], edge[1::2]):
        kept.append(text[at : starts[lo]])
        at = ends[hi - 1]
    return b"".join([*kept, text[at:]]).decode("utf-8", "replace")

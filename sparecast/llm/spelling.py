"""Spelling variants: words one edit apart, joined by asymmetric chunks, grouped under their most frequent form.

Two words are near when they differ by exactly one inserted, deleted or replaced
code point.  The join is asymmetric.  The shorter word (of two equally long ones,
either) is cut into two disjoint chunks, its halves, of which one edit leaves at
least one whole.  The other word gives all the positional grams that such a chunk
may equal: a chunk before the edit stands at its own position, one behind it at
that position or, in a word longer by one, shifted by one.

Words with a common half could make groups of any size, so a chunk isn't joined
alone.  The half that may hold the edit is cut in two by the same rule, and so
on, until at most ``OPEN`` letters are open, and all the chunks around these join as one
key.  A group of a key then holds words of one length that differ in ``OPEN`` letters
only on the chunks' side, and in one more on the grams' side, whatever the size
of the corpus.  (Words longer than ``OPEN * MOST_WINDOWS`` leave a share of
1 / ``MOST_WINDOWS`` open.)  A word gives as many keys as it has such windows, and
twice as many grams, one set for either length of its partner.  Keys are
64-bit hashes; every candidate pair is verified by its edit distance.

Words are counted inside tasks before they are shuffled.  A word's form is its most
frequent near word, if that is ``ratio`` times as frequent; following forms to the last
gives the root, found by doubling the steps in each round (frequencies rise
along forms, so there are no circles and few rounds).

Defined results: null and empty texts have no words; a null id counts as empty in the
damage rule; repeated rows count again; ties among forms go to the smallest word
in code-point order; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecast.llm.common import remove_folder, stored, utf8_texts, work_folder
from sparecast.llm.words import LOWER

#: Maximal runs in text whose A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
NO_RUN = re.compile("[^a-zÀ-ÿ]")
#: Characters of a text that are taken at a time (up to the end of a run).
PIECE = 1 << 22
#: Different words that a task holds before it passes their counts on.
HELD = 300_000
OPEN, MOST_WINDOWS = 2, 64


def text_words(text: str, prefix: bytes, least_length: int, damage_every: int | None) -> Counter[str]:
    """Counts of a text's words of ``least_length`` letters and more (A-Z are lower-cased already).

    With ``damage_every``, a run loses one letter where the crc32 ``h`` of ``<prefix><run>`` is
    divisible by it: the letter ``h % length``.
    """
    runs: Counter[str] = Counter()
    at = 0
    while at < len(text):
        stop = NO_RUN.search(text, at + PIECE)
        end = stop.start() if stop else len(text)
        runs.update(RUN.findall(text, at, end))
        at = end
    out: Counter[str] = Counter()
    start = zlib.crc32(prefix)
    for run, n in runs.items():
        if len(run) < least_length:
            continue
        if damage_every and (h := zlib.crc32(run.encode(), start)) % damage_every == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
            if len(run) < least_length:
                continue
        out[run] += n
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
                damage_every: int | None = None) -> DataFrame:
    """``word, n`` of the words with enough letters and occurrences in all texts."""

    def batch_of(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), utf8_texts(batch.column(1))):
                counts.update(text_words(text.translate(LOWER).decode(), f"{name or ''}:".encode(), least_length, damage_every))
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts.clear()
        if counts:
            yield batch_of(counts)

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("t"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


@lru_cache(maxsize=4096)
def windows(length: int) -> tuple[tuple[int, int], ...]:
    """The parts of a word that its chunks leave open, by halving."""
    out = [(0, length)]
    while len(out) < MOST_WINDOWS and max(b - a for a, b in out) > OPEN:
        out = [w for a, b in out for w in (((a, (a + b) // 2), ((a + b) // 2, b)) if b - a > OPEN else ((a, b),))]
    return tuple(out)


def _key(length: int, first: int, before: str, behind: str) -> int:
    key = xxhash.xxh3_64_intdigest(f"{length},{first},{before}|{behind}".encode())
    return key - (1 << 64) if key >> 63 else key


def chunk_keys(word: str) -> list[int]:
    """One key per window: the word's chunks around it."""
    return [_key(len(word), a, word[:a], word[b:]) for a, b in windows(len(word))]


def gram_keys(word: str, longer_by: int) -> list[int]:
    """The keys of the grams that equal the chunks of a near word shorter by 0 or 1."""
    length = len(word) - longer_by
    return [_key(length, a, word[:a], word[b + longer_by :]) for a, b in windows(length)]


def _keyed(words: DataFrame, grams: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys, row, longer = [], [], []
                for i, word in enumerate(part.column(0).to_pylist()):
                    for d in (0, 1) if grams else (0,):
                        own = gram_keys(word, d) if grams else chunk_keys(word)
                        keys += own
                        row += [i] * len(own)
                        longer += [d] * len(own)
                at_row = pa.array(row, pa.int64())
                columns = [pa.array(keys, pa.int64()), part.column(0).take(at_row), part.column(1).take(at_row)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(longer, pa.int32())], ["key", "word", "n", "longer"])

    return words.mapInArrow(run, "key long, word string, n long, longer int")


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, na, b, nb``: every pair of words (``word, n`` rows, each word once) one edit apart, once."""
    chunks = _keyed(words, grams=False).select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    grams = _keyed(words, grams=True).select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "longer")
    # a pair of equal length meets in both orders, and a longer word isn't equal to a shorter one
    met = chunks.join(grams, "key").filter("longer = 1 or a < b")
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb").distinct()


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """``word, root`` from ``word, form`` rows: forms followed to the last, twice as far in each round."""
    spark = forms.sparkSession
    ways = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/ways0")
    turn = 0
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = ways.join(further, "root", "left")
        if not both.filter("next is not null").limit(1).count():
            return ways
        turn += 1
        ways = stored(both.select("word", F.coalesce("next", "root").alias("root")), f"{folder}/ways{turn}")
        remove_folder(spark, f"{folder}/ways{turn - 1}")


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``word, n`` rows (each word once)."""
    folder = work_folder(words.sparkSession)
    words = stored(words.select("word", "n"), f"{folder}/words")
    pairs = stored(near_pairs(words), f"{folder}/pairs")
    links = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("other_n")).union(
        pairs.select("b", "a", "na"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))
    found = stored(found, f"{folder}/forms")
    roots = _roots(found.filter("form is not null"), folder)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5,
                      ratio: int = 5, damage_every: int | None = None) -> DataFrame:
    """Every word of ``docs`` with its form, root, count, near words and its form's count."""
    return group_variants(count_words(docs, id_col, text_col, least_length, least_count, damage_every), ratio)

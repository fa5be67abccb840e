"""Benchmark windows against brute force, on both paths."""

import collections

from sparecast.llm.decontaminate import contamination, decontaminated

from . import brute
from .conftest import ODD_TEXTS

ITEMS = [(1, "The quick, brown fox: jumps over the lazy dog and RUNS away!"), (2, None), (3, ""), (4, "one two"), (None, "no id here none"),
         (1, "漢字 \U0001F600 é"), (5, "word " * 12), (6, "jumps over the lazy dog and runs away far beyond the hills")]


def _items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def _expected(rows, items):
    return collections.Counter((i, *x) for (i, _), x in zip(rows, brute.contamination(rows, items)))


def test_odd_rows_on_both_paths(spark, odd):
    for limit in (32 << 20, 0):
        got = contamination(odd, _items(spark), max_broadcast_bytes=limit)
        assert collections.Counter(tuple(r) for r in got.collect()) == _expected(ODD_TEXTS, ITEMS)


def test_documents(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = _expected(rows, [(r.item_id, r.text) for r in items.collect()])
    for limit in (32 << 20, 0):
        got = contamination(docs, items, max_broadcast_bytes=limit)
        assert collections.Counter(tuple(r) for r in got.collect()) == expected


def test_empty_tables(spark, odd, empty):
    assert contamination(empty, _items(spark)).count() == 0
    none = _items(spark, [])
    assert contamination(odd, none).filter("contaminated").count() == 0
    assert decontaminated(odd, none).count() == len(ODD_TEXTS)


def test_dropping_and_cutting(spark, odd):
    dirty = {t for (_, t), x in zip(ODD_TEXTS, brute.contamination(ODD_TEXTS, ITEMS)) if x[-1]}
    dropped = decontaminated(odd, _items(spark))
    assert dropped.columns == odd.columns
    assert collections.Counter(r.text for r in dropped.collect()) == collections.Counter(t for _, t in ODD_TEXTS if t not in dirty)
    docs = spark.createDataFrame([(1, "before, one two; after", 99), (2, "clean", 5)], "doc_id long, text string, n_chars long")
    cut = {r.doc_id: (r.text, r.n_chars) for r in decontaminated(docs, _items(spark), mode="cut").collect()}
    assert cut == {1: ("before, ; after", 15), 2: ("clean", 5)}


def test_dropping_and_cutting_beyond_the_broadcast_bound(spark, odd, empty):
    docs = spark.createDataFrame([(1, "before, one two; after", 99, "k"), (2, "clean", 5, "k"), (2, "clean", 5, "k"), (3, None, 0, None),
                                  (4, "One TWO", 7, "é, one two, one two 漢字 \U0001F600 é.")], "doc_id long, text string, n_chars long, key string")
    cases = [(odd, "text"), (docs, "text"), (docs, "key"), (empty, "text")]
    for rows, col in cases:
        for mode in ("drop", "cut"):
            both = [decontaminated(rows, _items(spark), text_col=col, mode=mode, max_broadcast_bytes=n) for n in (32 << 20, 0)]
            assert both[1].schema == rows.schema
            small, large = (collections.Counter(map(tuple, x.collect())) for x in both)
            assert small == large
    cut = {r.doc_id: (r.text, r.n_chars) for r in decontaminated(docs, _items(spark), mode="cut", max_broadcast_bytes=0).collect()}
    assert cut == {1: ("before, ; after", 15), 2: ("clean", 5), 3: (None, 0), 4: ("", 0)}
    left = decontaminated(docs, _items(spark), max_broadcast_bytes=0).collect()
    assert sorted(r.doc_id for r in left) == [2, 2, 3]

"""Spelling variants against a plain count and a comparison of all pairs."""

import collections
import random
import re
import zlib

from sparecast.llm import spelling
from sparecast.llm.spelling import chunk_keys, gram_keys, group_variants, near_pairs, spelling_variants, windows

from . import brute
from .conftest import ODD_TEXTS


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def plain_counts(rows, every=199):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def plain_groups(n, ratio=5):
    by_hole = collections.defaultdict(set)  # a word without one letter: all words one edit apart share one
    for w in n:
        by_hole[w].add(w)
        for k in range(len(w)):
            by_hole[w[:k] + w[k + 1 :]].add(w)
    near = {w: {v for k in range(len(w)) for v in by_hole[w[:k] + w[k + 1 :]] | by_hole[w] if one_edit(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = collections.Counter()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None] += 1
    return out


def _rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return collections.Counter(tuple(r) for r in df.collect())


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain_groups(plain_counts(rows))
    assert _rows(spelling_variants(docs, damage_every=199)) == want and sum(1 for w in want if w[4]) > 10


def test_pairs_of_a_small_alphabet(spark):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("aabéÿ") for _ in range(rnd.choice([6, 6, 7, 8, 9]))) for _ in range(700)}
                   | {"a" * k for k in range(6, 30)} | {"a" * k + "b" + "a" * 9 for k in range(20)} | {"x" * 400, "x" * 401, "x" * 200 + "y" + "x" * 200})
    n = {w: rnd.choice([5, 6, 24, 25, 26, 125, 700]) for w in words}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    want = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    got = [(r.a, r.b) if r.a < r.b else (r.b, r.a) for r in near_pairs(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert _rows(group_variants(frame)) == plain_groups(n)


def test_one_edit_leaves_a_common_key():
    rnd = random.Random(1)
    for _ in range(2000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.choice([6, 7, 10, 31, 300])))
        k = rnd.randrange(len(a) + 1)
        b = a[:k] + rnd.choice("abc") + a[k:]
        assert set(chunk_keys(a)) & set(gram_keys(b, 1))
        c = a[:k] + "z" + a[k + 1 :] if k < len(a) else a
        assert set(chunk_keys(a)) & set(gram_keys(c, 0)) and set(chunk_keys(c)) & set(gram_keys(a, 0))
        assert [x for w in windows(len(a)) for x in range(*w)] == list(range(len(a)))


def test_roots_of_a_long_chain(spark):
    n = {"abcdef" + "x" * k: 5 * 6**k for k in range(12)}
    assert _rows(group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == plain_groups(n)


def test_odd_rows_and_pieces(spark, odd, empty, monkeypatch):
    assert spelling_variants(empty, damage_every=199).count() == 0
    many = [(i, t) for i, t in ODD_TEXTS for _ in range(5)] + [(100, "Straße ÀÉÎÕÜ× àéîõü÷ Kelvin wordsİwords " * 9)] * 2
    docs = odd
    for _ in range(4):
        docs = docs.union(odd)
    docs = docs.select("doc_id", "text", "n").union(spark.createDataFrame([(*r, 1) for r in many[-2:]], "doc_id long, text string, n long"))
    for every in (199, 2):
        assert _rows(spelling_variants(docs, damage_every=every)) == plain_groups(plain_counts(many, every))
    text = "one longword " * 50
    whole = spelling.text_words(text, b"7:", 6, 3)
    monkeypatch.setattr(spelling, "PIECE", 5)
    assert spelling.text_words(text, b"7:", 6, 3) == whole

"""Exact and near duplicates against brute force, on odd rows and on the smallest documents."""

import collections
import random

from pyspark.sql import functions as F

from sparecast.llm import near_dedup
from sparecast.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from sparecast.llm.near_dedup import components, drop_near_duplicates, near_duplicates

from . import brute
from .conftest import ODD_TEXTS


def _pairs(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def _expected_exact(rows, keep):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[brute.lower(t)].append(i)
    best = max if keep == "largest" else min
    out = collections.Counter()
    for i, t in rows:
        ids = groups[brute.lower(t)]
        kept = best((x for x in ids if x is not None), default=None)
        out[i, kept, len(ids), i == kept, brute.sha(brute.lower(t))] += 1
    return out


def test_exact_groups(spark, odd, sf):
    for rows, docs in ((ODD_TEXTS, odd), (_pairs(spark, sf), spark.read.parquet(f"{sf}/documents.parquet"))):
        for keep in ("largest", "smallest"):
            got = collections.Counter(tuple(r) for r in exact_duplicates(docs, keep=keep).collect())
            assert got == _expected_exact(rows, keep)


def test_exact_hot_group(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = exact_duplicates(docs).filter("group_size > 1").select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in got] == [(3999, 1334)]


def test_drop_exact_keeps_columns(odd, empty):
    got = drop_exact_duplicates(odd)
    assert got.columns == odd.columns
    texts = collections.Counter(brute.lower(r.text) for r in got.collect())
    assert texts == collections.Counter({brute.lower(t) for _, t in ODD_TEXTS})
    assert drop_exact_duplicates(empty).count() == 0 and exact_duplicates(empty).count() == 0


def _near_counter(rows, percent=85):
    return collections.Counter((i, n, c, i == c) for (i, _), (n, c) in zip(rows, brute.near(rows, percent)))


def test_near_groups(spark, odd, sf):
    for rows, docs in ((ODD_TEXTS, odd), (_pairs(spark, sf), spark.read.parquet(f"{sf}/documents.parquet"))):
        assert collections.Counter(tuple(r) for r in near_duplicates(docs).collect()) == _near_counter(rows)


def _copies(seed, n, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randrange(edits)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(9)}"
        out.append(" ".join(words))
    return out


def test_near_chains_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)  # so that buckets are cut into several blocks
    rows = list(enumerate(_copies(1, 60, 8) + _copies(2, 60, 4) + _copies(3, 3, 2)))
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collections.Counter(tuple(r) for r in near_duplicates(docs).collect()) == _near_counter(rows)


def test_near_empty(empty):
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_drop_near_leaves_one_of_each(spark, odd):
    got = drop_near_duplicates(odd)
    assert got.columns == odd.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect())
    # 2 is a copy of 1, 7 of 6; rows without words have no links
    assert ids == sorted([(False, i) for i in (1, 3, 4, 5, 6, 8, 9, 10, 11, 12)] + [(True, 0)] * 2)


def test_components_of_a_long_chain(spark, tmp_path):
    edges = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(200)] + [(b"a", b"b")]
    random.Random(3).shuffle(edges)
    links = spark.createDataFrame(edges, "a binary, b binary").repartition(7)
    got = {bytes(r.cls): bytes(r.root) for r in components(links, str(tmp_path)).collect()}
    assert got == {f"{i:04d}".encode(): b"0000" for i in range(1, 201)} | {b"b": b"a"}


def test_components_of_a_hub(spark, tmp_path):
    """Stars around the smallest, a middle and the largest node, chained; no task gets a hub's edges whole."""
    ends = [(hub, f"{side}{i:03d}") for side, hub in (("b", "a"), ("c", "b500"), ("d", "z")) for i in range(900)]
    edges = [tuple(sorted((u.encode(), v.encode()))) for u, v in [*ends, ("c001", "d001")]]
    random.Random(5).shuffle(edges)
    links = spark.createDataFrame(edges, "a binary, b binary").repartition(50)
    got = {bytes(r.cls): bytes(r.root) for r in components(links, str(tmp_path)).collect()}
    assert got == {n: b"a" for e in edges for n in e if n != b"a"}
    rows = spark.createDataFrame([("hub", i) for i in range(900)] + [("x", None), ("y", 3), ("y", None)], "k string, v int")
    least = near_dedup.with_least(rows, "k", "v", "m")
    assert {(r.k, r.m) for r in least.collect()} == {("hub", 0), ("x", None), ("y", 3)} and least.count() == 903


def test_components_end_when_only_stars_are_left(spark, tmp_path):
    """No round, and no comparison of two rounds' edges, for links that make stars already, or for none."""
    for name, edges in (("stars", [(b"a", b"b"), (b"a", b"c"), (b"d", b"e")]), ("none", []), ("path", [(b"a", b"b"), (b"b", b"c")])):
        links = spark.createDataFrame(edges, "a binary, b binary").repartition(1)
        got = {bytes(r.cls): bytes(r.root) for r in components(links, str(tmp_path / name)).collect()}
        assert got == {"stars": {b"b": b"a", b"c": b"a", b"e": b"d"}, "none": {}, "path": {b"b": b"a", b"c": b"a"}}[name]
        assert [f.name for f in (tmp_path / name).iterdir()] == ["edges0"], name


def test_only_stars(spark):
    def stars(*edges):
        return near_dedup._only_stars(spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary"))

    assert stars() and stars("ab") and stars("ab", "ac", "de")
    assert not stars("ab", "bc") and not stars("ac", "bc") and not stars("ab", "ab") and not stars("de", "ab", "bc", "ad")


def test_further_links_join_groups(spark, tmp_path):
    """Groups with further links are the components of all links, whatever ends (roots, others, new nodes) these join."""
    rnd = random.Random(11)
    for turn in range(3):
        edges = [tuple(sorted(f"{rnd.randrange(150):03d}".encode() for _ in "ab")) for _ in range(150)]
        edges = [e for e in edges if e[0] != e[1]]
        first, more = (spark.createDataFrame(e, "a binary, b binary").repartition(6) for e in (edges[:60], edges[60:] if turn else []))
        groups = near_dedup._joined(components(first, str(tmp_path / f"first{turn}")), more, str(tmp_path / f"more{turn}"))
        got = sorted((bytes(r.cls), bytes(r.root)) for r in groups.collect())
        assert got == sorted(near_dedup.forest(edges if turn else edges[:60]))


def test_bottoms_against_whole_sets():
    """No pair that reaches the threshold is dropped; small sets are decided by it, larger ones (beyond ``BOTTOM`` values) near it."""
    import numpy as np

    rnd = np.random.default_rng(4)
    for n in (1, 9, 300, 6 * near_dedup.BOTTOM):
        one = np.unique(rnd.integers(0, 1 << 32, n, dtype=np.uint32))
        others = [np.unique(np.concatenate([one[: int(len(one) * share)], rnd.integers(0, 1 << 32, n - int(n * share), dtype=np.uint32)]))
                  for share in (1, 0.97, 0.93, 0.7, 0.3, 0)]
        likeness = np.array([len(np.intersect1d(one, o)) / len(np.union1d(one, o)) for o in others])
        ok = near_dedup._bottoms_allow(one[: near_dedup.BOTTOM], [o[: near_dedup.BOTTOM] for o in others], len(one),
                                       np.array([len(o) for o in others]), 85)
        assert ok[likeness >= 0.85].all() and (n == 1 or not ok[likeness < 0.6].any())


def test_signature_estimates():
    import numpy as np

    rnd = np.random.default_rng(1)
    for share in (0.5, 0.85):
        errors = []
        for _ in range(60):
            x = rnd.integers(1, 1 << 62, 400).astype(np.uint64)
            cut = int(400 * 2 * share / (1 + share))
            y = np.concatenate([x[:cut], rnd.integers(1, 1 << 62, 400 - cut).astype(np.uint64)])
            a, b = near_dedup.super_minhash([np.unique(x), np.unique(y)])
            errors.append((a == b).mean() - cut / (800 - cut))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06

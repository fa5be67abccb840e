"""Vector codes against a full search in Python's integers, and the bounds against exact distances."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from sparecast.llm import vector_codes as vc
from sparecast.llm.vector_codes import Nearest, distances, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"
LIMIT = 1 << 60


def plain(rows, entries=16, rounds=6):
    def ok(v):
        return v is not None and v and len(v) % 8 == 0 and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, l, [max(-LIMIT, min(LIMIT, math.floor(4096 * x))) for x in v]) for i, v, l in rows if ok(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    if not kept:
        return collections.Counter()
    w = len(kept[0][2]) // 8
    cut = [[r[2][p * w : (p + 1) * w] for p in range(8)] for r in kept]
    books = [[list(cut[k][p]) for k in range(min(entries, len(cut)))] for p in range(8)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(8):
            groups = collections.defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            for e, vs in groups.items():
                books[p][e] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [[near(c[p], books[p]) for p in range(8)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    by_label = collections.Counter()
    for (_, l, _), e in zip(kept, error):
        by_label[l] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    most = (1 << 63) - 1
    return collections.Counter((i, "".join(f"{e:02x}" for _, e in f), min(x, most), min(by_label[l], most), digest)
                               for (i, l, _), f, x in zip(kept, found, error))


def _check(spark, rows, schema=SCHEMA, partitions=3):
    got = vector_codes(spark.createDataFrame(rows, schema).repartition(partitions))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == plain([r[:3] for r in rows])


def test_embeddings(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in e.collect()]
    assert collections.Counter(tuple(r) for r in vector_codes(e).collect()) == plain(rows)


def test_ties_repeats_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(vc, "HOT_LABELS", 4)  # labels on both paths of the label sums
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1, 0, 0, 1]) / 4096 for _ in range(16)], rnd.choice([1, 1, 1, None, 2, *range(10, 40)])) for i in range(400)]
    rows += [(1000 + i, [0.5] * 16, None) for i in range(300)] + rows[:5]
    _check(spark, rows)


def test_what_does_not_count(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7, -i / 3, 0.1 * i, 1.0, 2.0, -0.25, i * i / 9, 3.0], i % 2) for i in range(5)]
    bad = [(-9, None, 1), (-8, [], 1), (-7, [None] * 8, 1), (-6, [nan] + [0.0] * 7, 1), (-5, [inf] * 8, 1), (-4, [-inf] * 8, None), (-3, [0.0] * 9, 2)]
    _check(spark, good + bad + [(None, [9.0] * 8, 3), (77, [1.0] * 16, 4), (2, [1e-9] * 8, None)])
    assert vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vector_codes(spark.createDataFrame(bad, SCHEMA)).count() == 0


def test_large_components_and_extra_columns(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) * 10 ** rnd.choice([0, 3, 5, 8]) for _ in range(8)], i % 3, "x", 1) for i in range(60)]
    _check(spark, rows, SCHEMA + ", code string, x int")
    rows = [(i, [rnd.uniform(-1, 1) * 10 ** rnd.choice([0, 30, 300]) for _ in range(8)], None) for i in range(20)]
    _check(spark, rows)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_leave_out_work(seed):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-9, 9, (300, 3)) if seed % 2 else rnd.integers(-4000, 4000, (300, 8))
    book, b = x[:16].copy(), 4
    near = Nearest.full(x, book, b)
    for turn in range(6):
        new = book + rnd.integers(-2, 3, book.shape) * (10 >> turn)
        near.moved(book, new)
        need = near.settle(x, new)
        d = distances(x, new)
        assert (near.ids[:, 0] == d.argmin(1)).all()
        root = np.sqrt(d)
        rows = np.arange(len(x))
        assert (near.bounds[:, 0] >= root[rows, near.ids[:, 0]]).all()
        for k in range(1, b):
            assert (near.bounds[:, k] <= root[rows, near.ids[:, k]]).all()
        unlisted = root.copy()
        np.put_along_axis(unlisted, near.ids.astype(int), np.inf, 1)
        assert (near.bounds[:, b] <= unlisted.min(1)).all()
        if seed % 2 == 0 and turn > 3:
            assert (need == 1).mean() > 0.5
        if turn == 3:
            b = 2
            near = near.fewer(b)
        book = new

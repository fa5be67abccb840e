"""Shards against a plain search for the smallest capacity."""

import collections
import random
import zlib

from sparecast.llm import shards as sharding
from sparecast.llm.shards import Edges, edges_of_pieces, shard_documents

from . import brute
from .conftest import ODD_TEXTS


def _check(rows, got, shards):
    size = [len((t or "").encode()) + 8 for _, t in rows]
    want = collections.Counter((i, s, zlib.crc32((t or "").encode())) for (i, t), s in zip(rows, size))
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots, load = collections.defaultdict(list), collections.Counter()
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    groups = {}
    for (i, t), s in zip(rows, size):
        first, total = groups.get(t or "", (None, 0))
        groups[t or ""] = (min((x for x in (first, i) if x is not None), default=None), total + s)
    order = sorted(groups.items(), key=lambda g: (g[1][0] is not None, g[1][0] or 0, brute.sha(g[0])))
    assert max(load.values()) <= brute.smallest_capacity([g[1][1] for g in order], shards)
    home = collections.defaultdict(set)
    for r in got:
        home[r.text_crc32, r.size].add(r.shard)
    assert all(len(v) == 1 for v in home.values())


def test_documents(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for cells in (1 << 16, 16):  # with few cells the driver has to divide them several times
        monkeypatch.setattr(sharding, "CELLS", cells)
        _check(rows, shard_documents(docs).collect(), 24)


def test_odd_rows_and_hot_group(spark, odd, empty):
    _check(ODD_TEXTS, shard_documents(odd, shards=3).collect(), 3)
    assert shard_documents(empty).count() == 0
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i}") for i in range(900)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=8).collect()
    _check(rows, got, 8)


def test_capacity_search_with_unknown_cells():
    rnd = random.Random(4)
    for _ in range(60):
        sizes = [rnd.randrange(1, 9) if rnd.random() < 0.9 else rnd.randrange(50, 200) for _ in range(rnd.randrange(1, 300))]
        shards = rnd.randrange(1, 12)
        starts = [sum(sizes[:i]) for i in range(len(sizes))]
        edges = Edges(sum(sizes))
        while True:
            low, high = edges.capacity_range(shards)
            assert low < brute.smallest_capacity(sizes, shards) <= high
            cells = edges.open_cells(low, high, shards)
            if high - low <= 1 and len(edges.edge) > 2 or not cells:
                break
            found = {}
            for a, b in cells:
                step = max(1, -(-(b - a) // 3))
                for s in starts:
                    if a <= s < b:
                        first, _, n = found.get((a, (s - a) // step), (s, s, 0))
                        found[a, (s - a) // step] = (first, s, n + 1)
            edges.divide(*edges_of_pieces(*(list(x) for x in zip(*found.values()))))
        assert high == brute.smallest_capacity(sizes, shards)
        cuts = [*edges.even_cuts(high, shards), sum(sizes)]
        assert all(0 <= b - a <= high for a, b in zip(cuts, cuts[1:])) and set(cuts) <= {*starts, sum(sizes)}

"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find grouping.

A document's set holds its distinct word shingles (lower-cased A-Z, words
parted by ASCII white space); a document of fewer words has its whole word
sequence as the one shingle, and one without words has an empty set and no
links.  Two documents are linked when ``100 * |A & B| >= percent * |A | B|``.

1. Every text gives its set size, a 128-bit digest of the set and a
   SuperMinHash signature: the ranks that one element gives to the slots come
   from one random permutation, so they are correlated and the estimate has a
   lower variance than independent hashes.  Elements are drawn level by level,
   and a text stops as soon as no further level can lower any slot.
2. Documents with equal sets form a class; only classes go on.
3. Classes that share a band of signature slots are candidates.  First each
   bucket links its members to a hub class; what that leaves in
   different groups is then compared in full, pair by pair, inside blocks of
   a bucket.  So no link between groups is lost, while a bucket of one group
   costs one row per member instead of all its pairs.  The pairs left out are
   only those inside one group, which cannot change the grouping.
4. A pair whose signatures (and, in the second comparison, larger bottom
   sketches) agree far too little, five standard deviations below the
   threshold, or whose set sizes exclude the threshold is dropped; every other
   pair is confirmed on the full sets made from the whole texts.
5. Links are grouped by union-find inside partitions, then by distributed
   smallest-label rounds over what remains.

Shingles are compared by 64-bit hashes under a key drawn for each run.

At similarity 0.85 the 25 bands of 5 slots miss a pair with probability 4e-7.

Defined results: null text counts as empty; repeated rows are separate rows of
one class; a null id never labels a component unless all its ids are null;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparecast.llm.common import only_rows, per_batch, stored, utf8_texts, work_folder
from sparecast.llm.words import SPACED, Words, mix, new_key, passes, window_hashes

SLOTS, BANDS, ROWS = 128, 25, 5
HUBS = 3
BLOCK = 256
BOTTOM = 1024
MIN_PERCENT = 80
#: Tasks that one key's rows are spread over.
SALTS = 64

_U = np.uint64
_DRAWS = mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_LOW40 = _U((1 << 40) - 1)


def shingle_sets(texts: list[bytes], size: int, key: int = 0) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, SPACED, key)
    first, hashes = words.windows(size)
    cut = np.searchsorted(words.text[first], np.arange(len(texts) + 1)) if len(first) else np.zeros(len(texts) + 1, np.int64)
    out = []
    for i in range(len(texts)):
        own = hashes[cut[i] : cut[i + 1]]
        if not len(own) and words.counts[i]:
            own = window_hashes(words.hashes[words.bounds[i] : words.bounds[i + 1]], int(words.counts[i]))
        out.append(np.unique(own))
    return out


def super_minhash(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash signatures, one row of ``SLOTS`` 64-bit ranks per set (all ones for an empty set).

    At level ``j`` every element draws a number and the next slot of its own
    permutation (Fisher-Yates, replayed from the earlier draws).  A rank is the
    level followed by the number; a set whose slots all hold lower levels is done.
    """
    n = len(sets)
    ranks = np.full(n * SLOTS, ~_U(0))
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    items = np.concatenate(sets) if n else np.empty(0, np.uint64)
    swaps: list[np.ndarray] = []
    for level in range(SLOTS):
        if not len(items):
            break
        draw = mix(items ^ _DRAWS[level])
        pick = (level + ((draw >> _U(40)) * _U(SLOTS - level) >> _U(24))).astype(np.uint8)
        slot = pick.copy()
        for t in range(level - 1, -1, -1):
            slot[slot == swaps[t]] = t
        np.minimum.at(ranks, owner * SLOTS + slot, (_U(level) << _U(40)) | (draw & _LOW40))
        swaps.append(pick)
        open_sets = ranks.reshape(n, SLOTS).max(1) >= _U(level + 1) << _U(40)
        keep = open_sets[owner]
        if not keep.all():
            items, owner, swaps = items[keep], owner[keep], [s[keep] for s in swaps]
    return ranks.reshape(n, SLOTS)


def describe(texts: list[bytes], size: int, key: int = 0) -> tuple[np.ndarray, list[bytes | None], list[bytes | None]]:
    """Set sizes, set digests (class keys) and packed signatures; null keys for empty sets."""
    counts = np.zeros(len(texts), np.int64)
    keys: list[bytes | None] = [None] * len(texts)
    signs: list[bytes | None] = [None] * len(texts)
    for at, run in passes(texts):
        sets = shingle_sets(run, size, key)
        packed = mix(super_minhash(sets)).astype(np.uint16)
        for i, s in enumerate(sets):
            counts[at + i] = len(s)
            if len(s):
                with np.errstate(over="ignore"):
                    keys[at + i] = np.array([mix(s ^ _U(0x5851F42D4C957F2D)).sum(), mix(s ^ _U(0x14057B7EF767814F)).sum()], np.uint64).tobytes()
                signs[at + i] = packed[i].tobytes()
    return counts, keys, signs


def _keyed(rows: DataFrame, size: int, key: int) -> DataFrame:
    """Per row: id, text key, set size, class key and signature; no text goes on from here."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, keys, signs = describe(utf8_texts(batch.column(1)), size, key)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
            ["id", "key", "n", "cls", "sig"])

    return per_batch(rows.select("id", "t", "key"), run,
                     f"id {rows.schema['id'].dataType.simpleString()}, key string, n long, cls binary, sig binary")


def _bands(classes: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, SLOTS)
        cols = sig[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
        acc = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), cols.shape[:2])
        for r in range(ROWS):
            acc = mix(acc * _U(0x9E3779B97F4A7C15) + cols[:, :, r])
        cls = batch.column(0).take(pa.array(np.repeat(np.arange(len(sig)), BANDS)))
        band = np.tile(np.arange(BANDS, dtype=np.int32), len(sig))
        return pa.RecordBatch.from_arrays([pa.array(acc.ravel().view(np.int64)), pa.array(band), cls], ["bucket", "band", "cls"])

    return per_batch(classes.select("cls", "sig"), run, "bucket long, band int, cls binary")


def _least_agreement(percent: int) -> int:
    p = percent / 100
    return math.floor(SLOTS * (p - 5 * math.sqrt(p * (1 - p) / SLOTS)))


def _plausible(sig_a: np.ndarray, sig_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (100 * small >= percent * large) & ((sig_a == sig_b).sum(1) >= _least_agreement(percent))


def _hub_pairs(bands: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Each bucket's members paired with its hub, where sizes and signatures allow a link."""
    order = F.struct(F.xxhash64("cls", F.col("band") % HUBS), F.col("cls"))
    hubs = bands.groupBy("bucket").agg(F.min(order).alias("h"), F.min("cls").alias("lo"), F.max("cls").alias("hi"))
    hubs = hubs.filter("lo <> hi").select("bucket", F.col("h.cls").alias("a"))
    pairs = bands.join(hubs, "bucket").filter("cls <> a").select("a", F.col("cls").alias("b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = classes.select("cls", "n", "sig")
    both = (pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
            .select("a", "b", "na", "nb", "sa", "sb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, SLOTS) for i in (4, 5))
        ok = _plausible(sa, sb, batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
        return batch.select(["a", "b"]).filter(pa.array(ok))

    return per_batch(both, run, "a binary, b binary")


def _unresolved(bands: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one group, with the number of blocks of the bucket."""
    members = bands.join(groups.select("cls", "root"), "cls", "left").select(
        "bucket", "band", "cls", F.coalesce("root", "cls").alias("root"))
    split = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    split = split.filter("lo <> hi").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    return members.join(split, "bucket").select("bucket", "band", "cls", "root", "blocks")


def _bottoms(held: DataFrame, size: int, key: int) -> DataFrame:
    """``cls, bottom``: the ``BOTTOM`` smallest 32-bit values of each set (a smaller set is there in whole)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for _, texts in passes(utf8_texts(batch.column(1))):
            for s in shingle_sets(texts, size, key):
                out.append(np.unique((mix(s) >> _U(32)).astype(np.uint32))[:BOTTOM].tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["cls", "bottom"])

    return per_batch(held.select("cls", "t"), run, "cls binary, bottom binary")


def _bottoms_allow(one: np.ndarray, others: list[np.ndarray], n_one: int, n_others: np.ndarray, percent: int) -> np.ndarray:
    """Which of the ``others`` may be linked with ``one``; decided up to hash collisions for small sets, else five deviations wide."""
    values = np.concatenate(others)
    first = np.cumsum([0] + [len(o) for o in others[:-1]])
    there = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
    both = np.minimum(np.add.reduceat(there, first, dtype=np.int64) + 1, np.minimum(n_one, n_others))
    ok = 100 * both >= percent * (n_one + n_others - both)
    p = percent / 100
    for j in np.flatnonzero(np.maximum(n_one, n_others) > BOTTOM).tolist():
        merged = np.sort(np.concatenate([one, others[j]]))
        twice = merged[1:] == merged[:-1]
        kept = np.cumsum(np.concatenate([[True], ~twice])) <= BOTTOM  # the smallest values of the union
        ok[j] = int((twice & kept[1:]).sum()) >= BOTTOM * (p - 5 * math.sqrt(p * (1 - p) / BOTTOM))
    return ok


def _cross_pairs(members: DataFrame, classes: DataFrame, bottoms: DataFrame, percent: int) -> DataFrame:
    """All plausible pairs of a bucket whose members are in different groups.

    A bucket of many members is cut into blocks, each two of which meet in a
    task of their own, so no task holds more than two blocks of any bucket.  A
    pair that shares several bands is taken up in the first of them only.
    """
    met = (members.withColumn("own", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("bucket", "band", "cls", "root", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))
    about = classes.select("cls", "n", "sig").join(bottoms, "cls")
    met = met.join(about, "cls").select("bucket", "x", "y", "band", "own", "cls", "root", "n", "sig", "bottom")
    met = met.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        x, y, band = (rows.column(c)[0].as_py() for c in ("x", "y", "band"))
        own = rows.column("own").to_numpy()
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(-1, SLOTS)
        in_bands = sig[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
        bottom = [np.frombuffer(b, np.uint32) for b in rows.column("bottom").to_pylist()]
        n, root = rows.column("n").to_numpy(), np.unique(rows.column("root").to_pylist(), return_inverse=True)[1]
        left, right = [], []
        for i in range(len(n)):
            if own[i] != x:
                continue
            js = np.arange(i + 1, len(n)) if x == y else np.flatnonzero(own == y)
            js = js[root[js] != root[i]]
            js = js[_plausible(sig[js], sig[i][None], n[js], np.full(len(js), n[i]), percent)]
            js = js[(in_bands[js] == in_bands[i]).all(2).argmax(1) == band]
            if len(js):
                js = js[_bottoms_allow(bottom[i], [bottom[j] for j in js.tolist()], int(n[i]), n[js], percent)]
            left += [i] * len(js)
            right += js.tolist()
        if not left:
            return None
        cls = rows.column("cls").combine_chunks()
        pairs = zip(cls.take(pa.array(left)).to_pylist(), cls.take(pa.array(right)).to_pylist())
        a, b = zip(*(sorted(p) for p in pairs))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = t if rest is None else pa.concat_tables([rest, t])
            edges = _group_starts(rest)
            for s, e in zip(edges[:-1], edges[1:]):
                if e - s > 1 and (out := compare(rest.slice(s, e - s))) is not None:
                    yield out
            rest = rest.slice(edges[-1])
        if rest is not None and rest.num_rows > 1 and (out := compare(rest)) is not None:
            yield out

    return met.mapInArrow(run, "a binary, b binary").distinct()


def _group_starts(rows: pa.Table) -> list[int]:
    key = [rows.column(c).to_numpy() for c in ("bucket", "x", "y")]
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in key:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new).tolist()


def _texts_of(needed: DataFrame, classes: DataFrame, texts: DataFrame, path: str) -> DataFrame:
    """``cls, t``: one whole text for each of the wanted classes."""
    keys = needed.select("cls").distinct().join(classes.select("cls", "key"), "cls").select("cls", "key")
    return stored(texts.join(keys, "key").groupBy("cls").agg(F.first("t").alias("t")), path)


def _confirmed(pairs: DataFrame, held: DataFrame, size: int, percent: int, key: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = (pairs.join(held.toDF("a", "ta"), "a").join(held.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        ta, tb = utf8_texts(batch.column(2)), utf8_texts(batch.column(3))
        ok = np.zeros(len(a), bool)
        sets: dict[bytes, np.ndarray] = {}
        start = 0
        while start < len(a):  # a bounded number of texts' sets at a time
            todo: dict[bytes, bytes] = {}
            held_bytes, end = 0, start
            while end < len(a) and (end == start or held_bytes < 4 << 20):
                for k, t in ((a[end], ta[end]), (b[end], tb[end])):
                    if k not in todo:
                        todo[k] = t
                        held_bytes += len(t)
                end += 1
            sets = {k: s for k, s in sets.items() if k in todo}
            fresh = [k for k in todo if k not in sets]
            for at, run_ in passes([todo[k] for k in fresh]):
                for i, s in enumerate(shingle_sets(run_, size, key)):
                    sets[fresh[at + i]] = s
            for i in range(start, end):
                x, y = sets[a[i]], sets[b[i]]
                both_ = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * both_ >= percent * (len(x) + len(y) - both_)
            start = end
        return batch.select(["a", "b"]).filter(pa.array(ok))

    return per_batch(both, run, "a binary, b binary")


def forest(edges: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """``(node, smallest node of its group)`` for all nodes but the smallest, by union-find."""
    parent: dict[bytes, bytes] = {}

    def find(v: bytes) -> bytes:
        while (p := parent.setdefault(v, v)) != v:
            parent[v] = parent[p]
            v = parent[v]
        return v

    for u, v in edges:
        ru, rv = find(u), find(v)
        if ru != rv:
            parent[max(ru, rv)] = min(ru, rv)
    return [(v, r) for v in parent if (r := find(v)) != v]


def _local_forest(edges: DataFrame) -> DataFrame:
    """Union-find inside each partition; at most one edge per node and partition is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if out := forest(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))):
                b, a = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return edges.mapInArrow(run, "a binary, b binary")


def with_least(rows: DataFrame, key: str, value: str, out: str, spread_by: str | None = None) -> DataFrame:
    """``rows`` with the least ``value`` of all rows of their ``key`` (not null) in ``out``.

    The rows of one key are spread over up to ``SALTS`` tasks by ``spread_by``
    (``value`` by default): each task sends one least value per key with the salts that it saw, and
    the key's least value goes back to the salts that the key has, so there are never more of them than rows.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread_by or value), F.lit(SALTS)))
    whole = salted.groupBy(key).agg(F.min(value).alias(out), F.collect_set("salt").alias("salts"))
    return salted.join(whole.select(key, F.explode("salts").alias("salt"), out), [key, "salt"]).drop("salt")


def components(links: DataFrame, folder: str) -> DataFrame:
    """``(cls, root)`` for every linked class, ``root`` the smallest class of its group.

    Each round turns every node's edges toward its smallest neighbour (once
    with the larger ends, once with the smaller) until only stars are left; the
    rounds grow with the logarithm of the longest chain.  Nodes with many
    edges are first thinned by union-find inside partitions, and their edges are
    spread over the tasks.
    """
    edges = stored(_local_forest(links), f"{folder}/edges0")
    turn = 0
    while not _only_stars(edges):
        turn += 1
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        large = with_least(both, "u", "v", "m").filter("v > u").select(F.least("u", "m").alias("a"), F.col("v").alias("b"), "u")
        small = with_least(large, "b", "a", "m", spread_by="u").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        edges = stored(small.filter("a <> b").distinct(), f"{folder}/edges{turn}")
    return edges.select(F.col("b").alias("cls"), F.col("a").alias("root"))


def _only_stars(edges: DataFrame) -> bool:
    """Whether every larger end (``b``) of an edge has no other edge: then each ``a`` is the smallest of its group.

    An edge that is there twice counts as no star.
    """
    ends = edges.select(F.posexplode(F.array("a", "b")).alias("side", "node"))
    nodes = ends.groupBy("node").agg(F.sum("side").alias("as_larger"), F.count("*").alias("edges"))
    return not nodes.filter("as_larger > 0 and edges > 1").limit(1).count()


def _joined(groups: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """``groups`` (as of ``components``) with further links: only the roots that a link joins are grouped anew."""
    ends = links.join(groups.toDF("a", "ra"), "a", "left").join(groups.toDF("b", "rb"), "b", "left")
    ends = ends.select(F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
    tops = ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a <> b")
    above = components(tops, folder)
    below = groups.join(above.toDF("root", "top"), "root", "left")
    return below.select("cls", F.coalesce("top", "root").alias("root")).union(above)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """``id, n_shingles, component_id, kept``: one row per row of ``docs`` (see the module's text)."""
    rows = _grouped(docs, id_col, text_col, size, percent)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """``docs`` with exactly one document of every group, the one with the smallest id; all columns as they were."""
    rows = _grouped(docs, id_col, text_col, size, percent).filter("kept")
    grouped = rows.filter("root is not null").groupBy("root").agg(F.min(F.struct("id", "key")).alias("first")).select("first.*")
    alone = rows.filter("root is null").select("id", "key")
    return only_rows(docs, grouped.union(alone), id_col, F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256))


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``id, key, n, root, component, kept`` of every row; ``root`` is null for rows without words."""
    if not MIN_PERCENT <= percent <= 100:
        raise ValueError(f"the bands are laid out for similarities of {MIN_PERCENT} to 100 percent")
    folder, key = work_folder(docs.sparkSession), new_key()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("t")).withColumn("key", F.sha2("t", 256))
    sketches = stored(_keyed(rows, size, key), f"{folder}/sketches")
    classes = sketches.filter("cls is not null").groupBy("cls").agg(
        F.min("n").alias("n"), F.min("id").alias("id"), F.min(F.struct("key", "sig")).alias("k"))
    classes = stored(classes.select("cls", "n", "id", "k.key", "k.sig"), f"{folder}/classes")
    bands = stored(_bands(classes), f"{folder}/bands")
    texts = rows.select("key", "t")
    near = stored(_hub_pairs(bands, classes, percent), f"{folder}/near1")
    held = _texts_of(near.select(F.explode(F.array("a", "b")).alias("cls")), classes, texts, f"{folder}/texts1")
    links = stored(_confirmed(near, held, size, percent, key), f"{folder}/links1")
    groups = components(links, f"{folder}/groups1")
    members = stored(_unresolved(bands, groups), f"{folder}/members")
    held = _texts_of(members, classes, texts, f"{folder}/texts2")
    cross = _cross_pairs(members, classes, _bottoms(held, size, key), percent).join(near, ["a", "b"], "left_anti")
    more = stored(_confirmed(cross, held, size, percent, key), f"{folder}/links2")
    groups = _joined(groups, more, f"{folder}/groups2")
    rooted = classes.join(groups, "cls", "left").select("cls", "id", F.coalesce("root", "cls").alias("root"))
    labels = with_least(rooted, "root", "id", "component", spread_by="cls").select("cls", "root", "component")
    out = sketches.select("id", "key", "n", "cls").join(labels, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select("id", "key", "n", "root", component.alias("component"), F.col("id").eqNullSafe(component).alias("kept"))

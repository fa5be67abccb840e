"""Plain statements of what the operators must return, over lists of (id, text)."""

import collections
import hashlib
import re


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def ids_bytes(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near(rows, percent=85, size=5):
    """{row number: (set size, smallest id of its component)}, all pairs compared."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    label = {r: min((x for x in v if x is not None), default=None) for r, v in groups.items()}
    return [(len(sets[i]), label[find(i)]) for i in range(len(rows))]


def contamination(rows, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text))
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(item)
    out = []
    for _, text in rows:
        w, hit, found = word.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= {x for x in names if x is not None}
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def smallest_capacity(sizes, shards):
    def fits(c):
        used, room = 1, 0
        for s in sizes:
            if s > c:
                return False
            if room + s > c:
                used, room = used + 1, 0
            room += s
        return used <= shards

    lo, hi = 0, max(1, sum(sizes))
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    return hi

"""Plain Python statements that the tests hold the operators against."""

import hashlib
import math
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    k = min(k, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def groups(texts, k):
    """Group number of each text by links of Jaccard 0.8 or more; wordless texts link with nothing."""
    sets = [shingles(t, k) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))], sets


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def hits(text, items):
    """(number of words, hit positions, item ids) for (id, text) items."""
    w, at, ids = item_words(text), set(), set()
    for item, item_text in items:
        x = item_words(item_text)
        k = min(10, len(x))
        for win in {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if k else ():
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) == win:
                    at.update(range(p, p + k))
                    ids.add(item)
    return len(w), at, ids


def centroids(vectors: list, k: int = 8, dim: int = 64, rounds: int = 10, seed: int = 3) -> list:
    """Plain statement for (vec_id, components): (vec_id, cluster, distance, cluster_inertia, inertia, digest) rows."""
    def fits(v):
        return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x * 1024) <= (1 << 27) for x in v)

    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if fits(v)]
    centre = [q for _, q in sorted(((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), q) for i, q in kept))[:k]]

    def near(q):
        return min((sum((x - y) ** 2 for x, y in zip(q, c)), j) for j, c in enumerate(centre))

    for _ in range(rounds):
        groups = [[q for _, q in kept if near(q)[1] == j] for j in range(len(centre))]
        centre = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centre)]
    done = [(i, *near(q)) for i, q in kept]
    total = sum(d for _, d, _ in done)
    spent = [sum(d for _, d, j in done if j == c) for c in range(len(centre))]
    return [(i, j, d, spent[j], total, hashlib.sha256(",".join(map(str, centre[j])).encode()).hexdigest()) for i, d, j in done]

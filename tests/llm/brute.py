"""Plain versions of the operators, over lists of rows, for comparison."""
import collections
import hashlib
import math
import re
import zlib

import numpy as np


def crc(x):
    return zlib.crc32(("" if x is None else str(x)).encode())


def words(text):
    return (text or "").encode().lower().split()


def components(rows, k, percent):
    """{id: (set size, component)} of rows (id, text)."""
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        common = collections.Counter()
        for s in sets[i]:
            common.update(holders[s])
            holders[s].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def contamination(docs, items, size=10):
    """{id: (n_words, n_hit, item ids)}."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = split(text)
        n = min(size, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s:s + n])].add(str(item))
    lengths = sorted({len(w) for w in windows})
    out = {}
    for i, text in docs:
        w, hit, found = split(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        out[i] = (len(w), len(hit), sorted(found))
    return out


def without_boilerplate(rows, ratio, least):
    """[(id, source, text, n_lines, n_dropped)] of rows (id, source, text)."""
    pages, counts = collections.Counter(), collections.Counter()
    for _, source, text in rows:
        pages[source] += 1
        if text is not None:
            counts.update((source, x) for x in {x.strip(" \t\r") for x in text.split("\n")} - {""})
    out = []
    for i, source, text in rows:
        if text is None:
            out.append((i, source, None, 0, 0))
            continue
        all_lines = text.split("\n")
        kept = [x for x in all_lines if not (
            counts[source, x.strip(" \t\r")] >= least
            and counts[source, x.strip(" \t\r")] > ratio * pages[source])]
        out.append((i, source, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return out


def kneser_ney(rows, trained):
    """{id: (n_tokens, n_known, N, base, score)} of rows (id, text)."""
    tokens = lambda t: [*words(t), None]
    train = [tokens(t) for i, t in rows if trained(i)]
    unigrams = collections.Counter(w for t in train for w in t)
    n, v = sum(unigrams.values()), len(unigrams)
    pairs = collections.Counter(p for t in train for p in zip([0, *t], t))
    follows = collections.Counter(b for _, b in pairs)

    def discounts(counts):
        c = collections.Counter(counts.values())
        y = c[1] / (c[1] + 2 * c[2])
        return np.clip([1 - 2 * y * c[2] / c[1], 2 - 3 * y * c[3] / c[2], 3 - 4 * y * c[4] / c[3]],
                       0.05, [0.95, 1.95, 2.95])

    d2, d1 = discounts(pairs), discounts(follows)
    total, freed = collections.Counter(), collections.Counter()
    for (a, _), c in pairs.items():
        total[a] += c
        freed[a] += d2[min(c, 3) - 1]
    rest = sum(d1[min(c, 3) - 1] for c in follows.values()) / len(pairs)

    def p(a, b):
        low = rest / (v + 1) + (follows[b] - d1[min(follows[b], 3) - 1] if follows[b] else 0) / len(pairs)
        if not total[a]:
            return low
        c = pairs[a, b]
        return ((c - d2[min(c, 3) - 1] if c else 0) + freed[a] * low) / total[a]

    return {i: (len(t), sum(unigrams[w] > 0 for w in t), n,
                sum(math.log10((unigrams[w] + 1) / (n + v + 1)) for w in t),
                sum(math.log10(p(a, b)) for a, b in zip([0, *t], t)))
            for i, t in ((i, tokens(text)) for i, text in rows)}


def digest(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()

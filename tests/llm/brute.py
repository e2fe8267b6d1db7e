"""Plain Python forms of the contracts, for small tables."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} by resharing the excess until no source is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
            free.discard(s)
    return out


def shingles(text, k=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k \
        else frozenset([tuple(words)])


def jaccard_components(rows, percent=90):
    """{doc_id: (n_shingles, component)} of (doc_id, text) rows, by comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = root(ids[a]), root(ids[b])
                    parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in sets}

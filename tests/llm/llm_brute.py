"""Brute-force versions that the tests compare with."""

import itertools
import re
from collections import defaultdict


def collapsed(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute_links(rows, n=5, threshold=0.8):
    sets = []
    for _, text, *_ in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if x]
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    pairs = {p for v in inverted.values() for p in itertools.combinations(v, 2)}
    links, group = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            links[a] += 1
            links[b] += 1
            group[max(find(a), find(b))] = min(find(a), find(b))
    return [(rows[i][0], rows[find(i)][0], links[i]) for i in range(len(rows))]

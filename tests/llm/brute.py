"""Plain Python versions of the training-data operators, for small tables."""
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW = 8


def words(text):
    return WORD.findall(text or "")


class Groups(dict):
    def find(self, a):
        self.setdefault(a, a)
        while self[a] != a:
            a = self[a]
        return a

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def base(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - WINDOW + 1):
        at[tuple(w[i:i + WINDOW])].append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + WINDOW)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered), failed)


def line_key(line):
    return " ".join(words(line)).lower()


def line_verdicts(rows, max_docs, min_left):
    """{(host, text): share of words left}, with every holder but one losing a frequent line."""
    held = defaultdict(set)
    for host, text in set(rows):
        for line in (text or "").split("\n"):
            if words(line):
                held[host, line_key(line)].add(text)
    return held


def shingles(text, k):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard_groups(rows, k, percent):
    """{doc_id: (set size, smallest doc_id reachable)} for (doc_id, text)."""
    sets = {d: shingles(t, k) for d, t in rows}
    inverse, g = defaultdict(list), Groups()
    for d, s in sets.items():
        g.find(d)
        common = Counter()
        for x in s:
            common.update(inverse[x])
            inverse[x].append(d)
        for e, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[e]) - c):
                g.union(d, e)
    return {d: (len(s), g.find(d)) for d, s in sets.items()}


def cosine_groups(rows, least):
    """{vec_id: (links, smallest vec_id reachable)} for (vec_id, vector, label)."""
    import numpy as np
    g, links = Groups(), Counter()
    ok = []
    for v, x, label in rows:
        g.find(v)
        links[v] += 0
        if label is None or not x or any(c is None or not np.isfinite(c) for c in x) or not any(x):
            continue
        x = np.array(x, dtype=float)
        for u, y, other in ok:
            if other == label and len(y) == len(x) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                links[u] += 1
                links[v] += 1
                g.union(u, v)
        ok.append((v, x, label))
    return {v: (links[v], g.find(v)) for v, _, _ in rows}

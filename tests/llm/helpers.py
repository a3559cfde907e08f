"""Plain Python versions of the operators, for small tables."""

import hashlib
from collections import Counter, defaultdict

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return (text or "").encode().split()


def exact_groups(docs, largest=True):
    groups = defaultdict(list)
    for d, t in docs:
        groups[(t or "").translate(UPPER)].append(d)
    out = []
    for d, t in docs:
        own = groups[(t or "").translate(UPPER)]
        keep = max(own) if largest else min(own)
        out.append((d, keep, len(own), hashlib.sha256((t or "").translate(UPPER).encode()).hexdigest()))
    return sorted(out)


def substrings(docs, window):
    least = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shingles(text, size=5):
    w = [x.lower() for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


class Union:
    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[self.find(a)] = self.find(b)


def near_components(docs, size=5):
    sets = [shingles(t, size) for _, t in docs]
    u, by_id = Union(len(docs)), {}
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
        if s:
            if docs[i][0] in by_id:
                u.join(i, by_id[docs[i][0]])
            by_id[docs[i][0]] = i
    for i, s in enumerate(sets):
        for j, o in Counter(j for x in s for j in index[x] if j < i).items():
            if 100 * o >= 80 * (len(s) + len(sets[j]) - o):
                u.join(i, j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[u.find(i)] = min(least.get(u.find(i), d), d)
    return sorted((d, len(sets[i]), least[u.find(i)] if sets[i] else d) for i, (d, _) in enumerate(docs))


def repeated(ws, least=3):
    """(covered words, longest, maximal repeats (start, length, times)) of one text."""
    n = len(ws)
    windows = Counter(tuple(ws[i : i + least]) for i in range(n - least + 1))
    covered = set()
    for i in range(n - least + 1):
        if windows[tuple(ws[i : i + least])] > 1:
            covered |= set(range(i, i + least))
    maximal = []
    for length in range(least, n):
        places = defaultdict(list)
        for i in range(n - length + 1):
            places[tuple(ws[i : i + length])].append(i)
        twice = {k: v for k, v in places.items() if len(v) > 1}
        if not twice:
            break
        for v in twice.values():
            left = {ws[i - 1] if i else ("begin", i) for i in v}
            right = {ws[i + length] if i + length < n else ("end", i) for i in v}
            if len(left) > 1 and len(right) > 1:
                maximal.append((v[0], length, len(v)))
    return len(covered), max((m[1] for m in maximal), default=0), sorted(maximal)

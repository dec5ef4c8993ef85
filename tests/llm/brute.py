"""Plain-Python versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m.group()) >= 24]
    return sorted(out)


def base_digest(text):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base_spans(text)).encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows):
    """rows: (doc_id, text). doc_id -> smallest doc_id reachable by links of Jaccard similarity 0.8 or more."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    hold = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            hold[x].add(d)
    for d, s in sets.items():
        near = defaultdict(int)
        for x in s:
            for o in hold[x]:
                near[o] += 1
        for o, n in near.items():
            if o > d and 100 * n >= 80 * (len(s) + len(sets[o]) - n):
                a, b = find(d), find(o)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def word_runs(w, least=24):
    """(start, length, period) of maximal stretches of smallest period q and of max(least, 3 * q) words or more."""
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, 3 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def nearest_entry(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))


def vector_codes(vectors, parts=16, entries=64, rounds=2):
    """vectors: lists of integers in order of their ids. Entry numbers and error per vector, final codebooks."""
    w = len(vectors[0]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in vectors]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            held = defaultdict(list)
            for v in cut:
                held[nearest_entry(v[p], book)[1]].append(v[p])
            new.append([[sum(x) // len(held[k]) for x in zip(*held[k], strict=True)] if held[k] else e for k, e in enumerate(book)])
        books = new
    best = [[nearest_entry(v[p], book) for p, book in enumerate(books)] for v in cut]
    return [("".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b)) for b in best], books

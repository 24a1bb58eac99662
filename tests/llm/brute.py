"""Plain Python forms of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WHITE = r"[\x20\x09-\x0D]"


def words(text):
    return [w for w in re.split(WHITE + "+", text or "") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """doc_id -> (keep_id, group_size, kept, digest); unique ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(WHITE, "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), i == min(g)[1], sha(k)) for k, g in groups.items() for _, i in g}


def shingles(text, width):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


def components(rows, width, percent):
    """doc_id -> (set size, smallest linked id)."""
    sets = {i: shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def kept(rows, width):
    """doc_id -> (words, removed, digest of the rest); null ids are not handled here."""
    first, split = {}, [(i, words(t)) for i, t in rows]
    for i, w in sorted(split):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), i)
    out = {}
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def terms(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if w]


def contamination(rows, items, width):
    """doc_id -> (words, hit words, sorted item ids)."""
    windows = []
    for item, text in items:
        w = terms(text)
        if w:
            windows += [(str(item), tuple(w[k : k + width])) for k in range(max(1, len(w) - width + 1))]
    out = {}
    for i, t in rows:
        w, hit, found = terms(t), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found.add(item)
        out[i] = (len(w), len(hit), sorted(found))
    return out


def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def ranked(rows, items, limit):
    """item -> [(doc_id, score)], best first."""
    docs = [(i, search_terms(t)) for i, t in rows]
    n, length = sum(1 for _, w in docs if w), sum(len(w) for _, w in docs)
    holding = Counter(t for _, w in docs for t in set(w))
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(search_terms(text))
    out = {}
    for item, terms in asked.items():
        found = []
        for i, w in docs:
            tf = Counter(w)
            m = 50 + 50 * len(w) * n // length if length else 0
            parts = [math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t]]
            if sum(parts) > 0:
                found.append((i, sum(parts)))
        out[item] = sorted(found, key=lambda x: (-x[1], x[0] is None, x[0]))[:limit]
    return out

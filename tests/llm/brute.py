"""Plain versions of what the operators compute."""

import itertools
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(texts, percent=75):
    sets = {}
    for d, t in texts.items():
        w = SPACE.findall(lower(t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    have = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            have[x].append(d)
    shared = Counter(p for ds in have.values() for p in itertools.combinations(ds, 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


def repeated(texts, length=20):
    """doc -> (words, which of them are removed)."""
    seen, out = set(), {}
    for d in sorted(texts):
        w = SPACE.findall(texts[d] or "")
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            window = tuple(w[k : k + length])
            if window in seen:
                gone[k : k + length] = [True] * length
            seen.add(window)
        out[d] = w, gone
    return out


def contaminated(texts, items, window=10):
    """doc -> (number of words, hit words, items)."""
    have = defaultdict(set)
    for i, t in items.items():
        w = LETTERS.findall(lower(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            have[tuple(w[k : k + window])].add(i)
    out = {}
    for d, t in texts.items():
        w, hit, found = LETTERS.findall(lower(t)), set(), set()
        for size in {len(x) for x in have}:
            for k in range(len(w) - size + 1):
                if which := have.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= which
        out[d] = len(w), hit, sorted(found)
    return out

"""Plain definitions that the operators are held against."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return WORD.findall((text or "").translate(LOWER))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def dedup(rows, window=13):
    """(id, n_words, n_removed, sha) of (id, text) rows."""
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, n=4):
    w = lower_words(text)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near(rows, percent=85):
    """id -> smallest id reachable, all pairs compared."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            x = len(a & b)
            if x and 100 * x >= percent * (len(a) + len(b) - x):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: find(i) for i, _ in sets}


def hits(text, items, window=13):
    """(n_words, n_hit, sorted matching ids) of one text."""
    w = alnum_words(text)
    hit, found = [False] * len(w), set()
    for item, t in items:
        v = alnum_words(t)
        for run in {tuple(v[k:k + window]) for k in range(max(1, len(v) - window + 1))} - {()}:
            for k in range(len(w) - len(run) + 1):
                if tuple(w[k:k + len(run)]) == run:
                    hit[k:k + len(run)] = [True] * len(run)
                    found.add(item)
    return len(w), sum(hit), sorted(str(i) for i in found if i is not None)

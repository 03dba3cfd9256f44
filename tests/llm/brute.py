"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(0x41, 0x5B)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """doc_id -> (keep_id, group_size, kept, sha) for rows with distinct ids."""
    groups = collections.defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(FOLD)].append(doc)
    return {d: (max(g), len(g), d == max(g), sha(t)) for t, g in groups.items() for d in g}


def shingles(text):
    w = SPACED.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near(rows, percent=80):
    """doc_id -> (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def hits(rows, items, window=10):
    """doc_id -> (n_words, n_hit, item ids)."""
    patterns = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(FOLD))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            patterns[tuple(w[k : k + size])].add(str(item))
    lengths = {len(p) for p in patterns}
    out = {}
    for doc, text in rows:
        w = ALNUM.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in patterns:
                    hit.update(range(k, k + n))
                    found |= patterns[tuple(w[k : k + n])]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def repeats(rows, window=50):
    """doc_id -> (n_words, n_removed, sha of the kept words)."""
    words = {d: SPACED.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for k in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][k : k + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < d:
                gone[k : k + window] = [True] * window
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """source -> target, by sharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    open_, out, total = set(sizes), {}, sum(sizes.values())
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] >= most * sizes[s]}
        if not above:
            out |= share
            break
        out |= {s: float(most * sizes[s]) for s in above}
        open_ -= above
    return out

"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def lower_az(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def space_words(text):
    return [w for w in SPACE.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, size=50):
    """(doc_id, n_words, n_removed, kept_sha256) of every row, in the order of the rows."""
    smallest, docs = {}, [(d, space_words(t)) for d, t in rows]
    top = float("inf")
    for d, w in docs:
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            smallest[k] = min(smallest.get(k, top), top if d is None else d)
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - size + 1):
            if smallest[tuple(w[i:i + size])] < (top if d is None else d):
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), sha(" ".join(kept))))
    return out


def shingles(text, n=3):
    w = space_words(lower_az(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(sets, least=85):
    """Smallest reachable id of each (id, set), by all pairs that share a shingle."""
    ids = [d for d, _ in sets]
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for d, s in sets:
        for x in s:
            where[x].append(d)
    by = dict(sets)
    seen = set()
    for docs in where.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(by[a] & by[b])
                    if 100 * both >= least * (len(by[a]) + len(by[b]) - both):
                        ra, rb = find(a), find(b)
                        parent[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}

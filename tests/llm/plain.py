"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def groups(nodes, linked):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(docs, width, num, den):
    sets = {i: shingles(t, width) for i, t in docs}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    return groups(sets, [(a, b) for a, b in pairs
                         if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])])


def without_repeats(docs, length=100):
    """{doc_id: (bytes, removed, spans, kept)}."""
    seen, out = {}, {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if seen.setdefault(raw[p:p + length], (i, p)) != (i, p):
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        out[i] = (len(raw), sum(gone), spans, kept)
    return out


def sha(raw):
    return hashlib.sha256(raw).hexdigest()
